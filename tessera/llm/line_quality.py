"""Line-first cleaning with DataFrame functions only.

Every line is judged alone (closing punctuation, shouting, symbols, navigation,
boilerplate, repetition); failing lines go, and a document that loses too large
a share of its words is rejected.  All work is done inside the row, so there is
no shuffle and no group to become hot.

Null texts count as empty.  Empty texts, and texts below ``MIN_WORDS``, fail
the base rules.  Each input row gives one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD, part, tuck, untuck

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
#: Base rules: fewest words; greatest share (percent) of words in repeated 3-word windows.
MIN_WORDS, MAX_REPEAT = 50, 50
#: Line rules. A line of at most SHORT words must close a sentence; beyond these parts of its words, doubled exclamation marks, symbols or separators fail it.
SHORT, SHOUT, SYMBOL, NAVIGATION = 4, 0.25, 0.5, 0.25
#: Greatest share of a document's words that may go with its failing lines.
MAX_LOSS = 0.5
CLOSED = r"[.!?:;…。！？][\x22'”’»)\]]*[\x20\x09-\x0D]*$"
SHOUTED = r"[!?]{2,}"
SEPARATOR = r"(^|[\x20\x09])[|»›·•>/](?=[\x20\x09]|$)"
BOILERPLATE = (r"(?i)(enable javascript|cookie policy|uses cookies|accept cookies|lorem ipsum|terms of (use|service)|privacy policy"
               r"|all rights reserved|subscribe to our|sign (in|up) (to|for)|click here|skip to (main )?content|read more|back to top)")
#: Boilerplate phrases fail a line of at most so many words.
BOILERPLATE_WORDS = 30


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def line_passes(line: Column) -> Column:
    n = F.regexp_count(line, F.lit(WORD))
    return ((n > SHORT) | line.rlike(CLOSED)) \
        & (F.regexp_count(line, F.lit(SHOUTED)) < F.greatest(n * SHOUT, F.lit(1.0))) \
        & (F.regexp_count(line, F.lit(SYMBOLS)) <= n * SYMBOL) \
        & (F.regexp_count(line, F.lit(SEPARATOR)) < F.greatest(n * NAVIGATION, F.lit(1.0))) \
        & ~((n <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE))


def repeated_words(df: DataFrame, name: str = "n_repeat_words") -> DataFrame:
    """Words inside 3-word windows that occur twice or more in the row's ``_w``.

    Windows are hashed and sorted with their places within the row; equal
    neighbours mark the places, and the marked stretches are measured.
    """
    df = df.withColumn("_g", F.expr(
        "if(size(_w) < 3, cast(array() as array<bigint>), transform(sequence(0, size(_w) - 3), i -> xxhash64(get(_w, i), get(_w, i + 1), get(_w, i + 2))))"))
    df = df.withColumn("_s", F.expr(
        "if(size(array_distinct(_g)) = size(_g), null, sort_array(transform(_g, (x, i) -> struct(x as h, i as i))))"))
    df = df.withColumn("_p", F.expr(
        "sort_array(transform(filter(_s, (p, i) -> p.h <=> get(_s, i - 1).h or p.h <=> get(_s, i + 1).h), p -> p.i))"))
    return df.withColumn(name, F.expr(
        "coalesce(aggregate(transform(_p, (p, i) -> least(3, coalesce(get(_p, i + 1) - p, 3))), 0L, (a, x) -> a + x), 0L)")).drop("_g", "_s", "_p")


def clean_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts, ``cleaned`` (text of the lines that stay), ``base_failed`` and ``kept``; input columns of these names give way."""
    df = tuck(docs).withColumn("_t", F.coalesce(part(text_col), F.lit(""))).withColumn("_w", words(F.col("_t")))
    df = df.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD)))
    df = df.withColumn("_u", F.array_distinct("_l")).withColumn("_k", F.filter("_u", line_passes))
    df = repeated_words(df).withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": (F.length("_t") - F.regexp_count("_t", F.lit(SPACE))).cast("long"),
        "n_symbols": F.regexp_count("_t", F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("_l") - F.size("_u")).cast("long"),
        "cleaned": F.array_join("_k", "\n"),
    })
    df = df.withColumn("n_kept_words", F.regexp_count("cleaned", F.lit(WORD)).cast("long"))
    df = df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")))
    df = df.withColumn("kept", ~F.col("base_failed") & (F.col("n_kept_words") >= F.col("n_words") * (1 - MAX_LOSS)))
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_kept_words", "cleaned", "base_failed", "kept"]
    return untuck(df, docs.columns, *new)


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_COUNT = "len(regexp_extract_all({}, {}))".format
#: Look-ahead is not in DuckDB's patterns; a separator is told there by its neighbours one word at a time.
ORACLE = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, regexp_extract_all(t, {_sql(WORD)}) as ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {_sql(WORD)})) as ls from d),
tri as (select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g from w, unnest(range(1, len(ws) - 1)) as r(i)),
rep as (select doc_id, i, count(*) over (partition by doc_id, g) as c from tri),
cov as (select doc_id, count(distinct i + k) as n from rep, (values (0), (1), (2)) as o(k) where c > 1 group by doc_id),
lines as (select doc_id, unnest(list_distinct(ls)) as x from w),
judged as (select doc_id, {_COUNT('x', _sql(WORD))} as n from lines
  where ({_COUNT('x', _sql(WORD))} > {SHORT} or regexp_matches(x, {_sql(CLOSED)}))
    and {_COUNT('x', _sql(SHOUTED))} < greatest({_COUNT('x', _sql(WORD))} * {SHOUT}, 1)
    and {_COUNT('x', _sql(SYMBOLS))} <= {_COUNT('x', _sql(WORD))} * {SYMBOL}
    and len(list_filter(regexp_split_to_array(x, '[ \\t]'), lambda y: regexp_matches(y, '^[|»›·•>/]$'))) < greatest({_COUNT('x', _sql(WORD))} * {NAVIGATION}, 1)
    and not ({_COUNT('x', _sql(WORD))} <= {BOILERPLATE_WORDS} and regexp_matches(x, {_sql(BOILERPLATE)}))),
held as (select doc_id, sum(n) as n from judged group by doc_id),
base as (select w.doc_id, len(ws)::bigint as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
    {_COUNT('t', _sql(SYMBOLS))}::bigint as n_symbols, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
    coalesce(cov.n, 0)::bigint as n_repeat_words, coalesce(held.n, 0)::bigint as n_kept_words
  from w left join cov on cov.doc_id = w.doc_id left join held on held.doc_id = w.doc_id)
select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT} * n_words as base_failed,
  not (n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT} * n_words) and n_kept_words >= n_words * {1 - MAX_LOSS} as kept
from base
"""
