"""Byte-level BPE encoding and decoding of whole texts, long ones in parallel pieces.

Short texts are encoded where they are scanned.  A text of more than ``SEGMENT``
characters is cut into halves of halves, the pieces are dealt to tasks and
encoded there, and the encodings are put together along the same tree.  A piece
that ends where the pre-tokenizer must end a word needs no care.  Where no such
place was near (a long run without white space), a window of tokens on both
sides of the join is encoded again and grows until its first token equals the
left side's and its last token the right side's; as a token sequence is the
BPE encoding of its text exactly if every neighbouring pair is, the rest then
stands.  The same joins serve long runs inside one piece.

Ids, special tokens and decoded texts are those of the ``tokenizers`` library
for the given file with ``add_special_tokens=False`` and
``skip_special_tokens=False``.  Null texts count as empty.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Characters of a text that one task encodes at once; of a run without white space before it is halved; words kept by a worker.
SEGMENT, RUN, CACHE = 32768, 4096, 500_000
#: Characters of texts whose words are looked up at once.
GROUP = 1 << 20
_TIGHT = re.compile(r" (?=\s)|(?<=\s) |\A | \Z")


def byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


#: Kinds of characters; ``ODD`` are those about which nothing is assumed, ``BORDER`` is the border of a text.
SPACE, LETTER, NUMBER, OTHER, ODD, BORDER, BLANK = range(7)


def _kinds() -> np.ndarray:
    """Kind of every character for the byte-level pre-tokenizer.

    Known are the characters of the first plane that are letters, numbers or
    neither in Unicode 3.2 as in Python's version, and the common white space.
    """
    space = "\t\n\x0b\x0c\r\xa0\u3000"

    def kind(c: str) -> int:
        if c == " ":
            return BLANK
        if c in space:
            return SPACE
        new, old = unicodedata.category(c)[0], unicodedata.ucd_3_2_0.category(c)
        if c.isspace() and c > "\x7f" or new != old[0] or old in ("Cn", "Cs", "Co") or c == "\u180e":
            return ODD
        return {"L": LETTER, "N": NUMBER}.get(new, OTHER)

    return np.append(np.array([kind(chr(i)) for i in range(1 << 16)], np.uint8), np.full(0x100000, ODD, np.uint8))


def _pairs() -> np.ndarray:
    """Whether a word starts at a character, by 8 * the kind before it + its own."""
    white = (SPACE, BLANK)

    def starts(a: int, b: int) -> bool:
        if b == BORDER or b in white:
            return b == BORDER or a not in white  # white space behind white space is looked at again
        return a == SPACE or a not in white and a != b

    return np.array([starts(a, b) for a in range(8) for b in range(8)])


def _word_starts(cp: np.ndarray, kind: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Where the pre-tokenizer's words start in texts with a border before and behind each.

    A word is a run of one kind, with the blank before it.  Of a longer run of
    white space the last character stands apart where a text goes on, and
    's 't 're 've 'm 'll 'd are words of their own where a word may start at the mark.
    """
    last = len(cp) - 1
    before = np.append(np.uint8(BORDER), kind[:-1])
    start = pairs.take(8 * before + kind)
    run = np.flatnonzero(((kind == SPACE) | (kind == BLANK)) & ((before == SPACE) | (before == BLANK)))
    start[run] = ~np.isin(kind[run + 1], (SPACE, BLANK, BORDER))
    mark = np.flatnonzero(cp == 39)
    mark = mark[(kind[mark] == OTHER) & ~np.isin(before[mark], (OTHER, BLANK))]
    if len(mark):
        third = np.minimum(mark + 2, last)
        c, d = cp[mark + 1], cp[third]
        word = (kind[mark + 1] == LETTER)
        one = word & np.isin(c, [ord(x) for x in "stmd"])
        two = word & (kind[third] == LETTER) & (np.isin(c, [ord("r"), ord("v")]) & (d == ord("e")) | (c == ord("l")) & (d == ord("l")))
        start[mark[one | two] + 1] = False
        start[mark[one] + 2] = True
        start[mark[two] + 3] = True
    return np.flatnonzero(start)


class Codec:
    """Encoder and decoder of one tokenizer file; built once in each Python worker."""

    _made: dict[str, "Codec"] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        letters = byte_alphabet()
        self.model, self.letters = self.lib.model, {b: c for c, b in letters.items()}
        self.special = {t.content: i for i, t in self.lib.get_added_tokens_decoder().items()}
        self.bytes = [b""] * self.lib.get_vocab_size()
        for token, i in self.lib.get_vocab().items():
            self.bytes[i] = token.encode() if token in self.special else bytes(letters[c] for c in token)
        self.size = np.array([len(b) for b in self.bytes], np.int64)
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.words: dict[str, bytes] = {}  # ids of a word with a blank in front
        self.heads: dict[str, bytes] = {}  # ids of the first word of a text
        self.plain: dict[str, bytes] = {}  # ids of a word of the pre-tokenizer
        self.past: dict[str, bytes] = {}  # those kept before ``plain`` was full
        pre = self.lib.pre_tokenizer
        self.kinds, self.pairs = _kinds(), _pairs()
        self.byte_level = self.lib.normalizer is None and isinstance(pre, ByteLevel) and pre.use_regex and not pre.add_prefix_space

    @classmethod
    def of(cls, path: str) -> "Codec":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    # -- encoding: ids as little-endian unsigned 32-bit integers in bytes

    def encode(self, text: str) -> bytes:
        if self.cut and len(parts := self.cut.split(text)) > 1:
            return b"".join(np.uint32(self.special[p]).tobytes() if i % 2 else self.encode_plain(p) for i, p in enumerate(parts))
        return self.encode_plain(text)

    def encode_plain(self, text: str) -> bytes:
        """A blank between two other characters that are no white space always starts a word, so texts are split there and words kept."""
        if not text:
            return b""
        if self.byte_level and (got := self.encode_words([text])[0]) is not None:
            return got
        if _TIGHT.search(text):
            return self.run(text)
        head, *rest = text.split(" ")
        known = self.words
        got = list(map(known.get, rest))
        if None in got:
            new = {w for w, g in zip(rest, got) if g is None}
            own = {w: self.run(" " + w) for w in new if len(w) >= RUN}
            new = [w for w in new if len(w) < RUN]
            if len(known) + len(new) > CACHE:
                known.clear()
            self.learn(new)
            got = [own[w] if w in own else known[w] if g is None else g for w, g in zip(rest, got)]
        if (first := self.heads.get(head)) is None:
            first = self.run(head)
            if len(head) < RUN:
                if len(self.heads) >= CACHE:
                    self.heads.clear()
                self.heads[head] = first
        return first + b"".join(got)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """encode() of every text, many at once."""
        if not self.byte_level:
            return [self.encode(t) for t in texts]
        whole = [None if self.cut and self.cut.search(t) else t for t in texts]
        out: list[bytes | None] = []
        while len(out) < len(texts):
            n, size = len(out), 0
            while n < len(texts) and (not size or size + len(whole[n] or "") <= GROUP):
                size += len(whole[n] or "")
                n += 1
            out += self.encode_words([t or "" for t in whole[len(out):n]])
        return [self.encode(t) if w is None else self.encode_plain(t) if x is None else x for t, w, x in zip(texts, whole, out)]

    def encode_words(self, texts: list[str]) -> list[bytes | None]:
        """Ids of texts of known characters by the pre-tokenizer's words, each encoded once and kept; None for others."""
        joined = "\0".join(["", *texts, ""])
        cp = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        border = np.append(0, np.cumsum([len(t) + 1 for t in texts]))
        kind = self.kinds.take(cp)
        kind[border] = BORDER
        odd = np.flatnonzero(kind == ODD)
        if len(odd):
            bad = {*(np.searchsorted(border, odd) - 1).tolist()}
            known = iter(self.encode_words([t for i, t in enumerate(texts) if i not in bad]) if len(bad) < len(texts) else ())
            return [None if i in bad else next(known) for i in range(len(texts))]
        starts = _word_starts(cp, kind, self.pairs)
        raw = np.frombuffer(joined.encode(), np.uint8)
        edge = starts if len(raw) == len(cp) else np.flatnonzero((raw & 0xC0) != 0x80)[starts]  # characters' first bytes
        cells = pa.StringArray.from_buffers(len(edge), pa.py_buffer(np.append(edge, len(raw)).astype(np.int32)), pa.py_buffer(raw)).dictionary_encode()
        ids = pa.array(self.ids_of(cells.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        off = np.frombuffer(ids.buffers()[1], np.int64)[:len(ids) + 1] // 4
        flat, first, size = np.frombuffer(ids.buffers()[2], "<u4"), off[:-1], np.diff(off)
        word = cells.indices.to_numpy()
        n = size[word]
        at = np.searchsorted(starts, border)
        n[at] = 0
        past = np.cumsum(n)
        tokens = flat[np.repeat(first[word] - (past - n), n) + np.arange(past[-1])].tobytes()
        cuts = (4 * past[at]).tolist()
        return [tokens[a:b] for a, b in zip(cuts, cuts[1:])]

    def ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of different words; when half of ``CACHE`` is full, it is kept as it is while the other half fills anew."""
        if len(self.plain) >= CACHE // 2:
            self.past, self.plain = self.plain, {}
        got, plain, past = list(map(self.plain.get, words)), self.plain, self.past
        for i in [i for i, x in enumerate(got) if x is None]:
            w = words[i]
            x = past.get(w)
            if x is None:
                if len(w) >= RUN:
                    got[i] = self.run(w)
                    continue
                x = self.word_ids(w)
            got[i] = plain[w] = x
        return got

    def word_ids(self, word: str) -> bytes:
        """Ids of one word, by the model alone."""
        return array("I", [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))]).tobytes()

    def learn(self, words: list[str]) -> None:
        """Encodes new words, each with a blank in front, as one text and tells their ids apart by their bytes."""
        for at in range(0, len(words), 10_000):
            part = words[at:at + 10_000]
            ids = np.array(self.lib.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.searchsorted(np.cumsum(self.size[ids]), np.cumsum([len(w.encode()) + 1 for w in part])) + 1
            raw = ids.tobytes()
            self.words.update(zip(part, [raw[4 * a:4 * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]))

    def library(self, text: str) -> np.ndarray:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, "<u4")

    def run(self, text: str) -> bytes:
        """Halves of a long unsplit text are encoded and put together."""
        if len(text) <= RUN:
            return self.library(text).tobytes()
        mid = len(text) // 2
        return self.join(text[:mid], self.run(text[:mid]), text[mid:], self.run(text[mid:]))

    def join(self, left: str, a: bytes, right: str, b: bytes) -> bytes:
        """Encoding of left + right from the encodings of both."""
        if not left or not right:
            return a + b
        x, y = last_break(left + right[:1], len(left)), first_break(left[-3:], right)
        if x == len(left) or y == 0:
            return a + b
        a, b = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
        i, j = self.at_byte(a, len(left[:x].encode())), self.at_byte(b, len(right[:y].encode()))
        mid = left[x:] + right[:y]
        if len(mid) > 64 and len(self.lib.pre_tokenizer.pre_tokenize_str(mid)) == 1:
            inner = self.grow(a[i:], b[:j])
        else:
            inner = self.library(mid)
        return b"".join(z.tobytes() for z in (a[:i], inner, b[j:]))

    def at_byte(self, ids: np.ndarray, n: int) -> int:
        """Tokens that make up the first n bytes; both sides have a token border there."""
        return int(np.searchsorted(np.cumsum(self.size[ids]), n, "left")) + 1 if n else 0

    def grow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Joins the encodings of two parts of one word by growing windows of tokens."""
        k = 4
        while True:
            i, j = max(0, len(a) - k), min(len(b), k)
            raw = [self.bytes[t] for t in a[i:].tolist()], [self.bytes[t] for t in b[:j].tolist()]
            try:  # a window starts and ends between characters
                text = (b"".join(raw[0]) + b"".join(raw[1])).decode()
                new = self.library(text) if len(self.lib.pre_tokenizer.pre_tokenize_str(text)) == 1 else None
            except UnicodeDecodeError:
                new = None
            if new is not None and (i == 0 or new[0] == a[i]) and (j == len(b) or new[-1] == b[j - 1]):
                return np.concatenate([a[:i], new, b[j:]])
            if i == 0 and j == len(b):
                return self.library(self.decode_ids(np.concatenate([a, b])))
            k *= 2

    # -- decoding

    def decode_ids(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")

    # -- cutting

    def segments(self, text: str, size: int) -> list[str]:
        """Halves of halves of at most ``size`` characters or little more; never cut inside a special token."""
        if len(text) <= size:
            return [text]
        mid = len(text) // 2
        near = text[mid - 1024: mid + 1024] if size > 2048 else ""
        m = re.search(r"\S (?=\S)", near)
        cut = mid - 1024 + m.start() + 1 if m else mid
        for s in self.special:
            at = text.find(s, max(0, cut - len(s) + 1), cut + len(s) - 1)
            if 0 <= at < cut < at + len(s):
                cut = at
        if not 0 < cut < len(text):
            return [text]
        return self.segments(text[:cut], size) + self.segments(text[cut:], size)

    def tree(self, nodes: list[tuple[str, bytes]]) -> bytes:
        """Puts neighbouring pieces together until one is left."""
        while len(nodes) > 1:
            nodes = [(nodes[i][0] + nodes[i + 1][0], self.join_special(*nodes[i], *nodes[i + 1])) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
        return nodes[0][1]

    def join_special(self, left: str, a: bytes, right: str, b: bytes) -> bytes:
        """join() when either side may hold special tokens: they are borders, so only the text between them takes part."""
        if not self.cut or not (self.cut.search(left) or self.cut.search(right)):
            return self.join(left, a, right, b)
        l0 = max((m.end() for m in self.cut.finditer(left)), default=0)
        r0 = m.start() if (m := self.cut.search(right)) else len(right)
        x, y = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
        i, j = self.at_byte(x, len(left[:l0].encode())), self.at_byte(y, len(right[:r0].encode()))
        return x[:i].tobytes() + self.join(left[l0:], x[i:].tobytes(), right[:r0], y[:j].tobytes()) + y[j:].tobytes()


def _kind(c: str) -> str:
    """Letter, digit or other of plain Latin characters; '' of all others, about which nothing is assumed."""
    if c.isspace():
        return " "
    if c > "ɏ":
        return ""
    return "l" if c.isalpha() else "d" if c.isdigit() and c < "\x80" else "o" if c < "\x80" else ""


def _breaks(text: str, p: int) -> bool:
    """True only if a word must end before text[p]: white space follows other characters, or the kind changes and no apostrophe is near."""
    x, y = _kind(text[p - 1]), _kind(text[p])
    if x == " ":
        return False
    return y == " " or bool(x and y) and x != y and "'" not in text[max(0, p - 3):p]


def last_break(text: str, most: int) -> int:
    return next((p for p in range(most, 0, -1) if p < len(text) and _breaks(text, p)), 0)


def first_break(before: str, text: str) -> int:
    both, n = before + text, len(before)
    return next((p - n for p in range(n, len(both)) if p and _breaks(both, p)), len(text))


# ---- on Spark ------------------------------------------------------------------------

def _columns(ids: list[bytes], codec: Codec, want: list[str]) -> dict[str, pa.Array]:
    make = {
        "n_tokens": lambda: pa.array([len(x) // 4 for x in ids], pa.int64()),
        "ids": lambda: pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())),
        "ids_binary": lambda: pa.array(ids, pa.binary()),
        "ids_sha256": lambda: pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
        "decoded": lambda: pa.array([codec.decode_ids(np.frombuffer(x, "<u4")) for x in ids], pa.string()),
        "decoded_sha256": lambda: pa.array([hashlib.sha256(codec.decode_ids(np.frombuffer(x, "<u4")).encode()).hexdigest() for x in ids], pa.string()),
    }
    return {w: make[w]() for w in want}


#: ``ids_binary`` holds the ids as little-endian unsigned 32-bit integers.
KINDS = {"n_tokens": "long", "ids": "array<int>", "ids_binary": "binary", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}


def encode(docs: DataFrame, tokenizer: str, keep: list[str], text_col: str = "text",
           want: tuple[str, ...] = ("n_tokens", "ids"), segment: int = SEGMENT) -> DataFrame:
    """Columns ``keep`` of every row and what is wanted of its encoding (a choice of ``KINDS``).

    ``tokenizer`` is the file's path, the same on every machine.  Texts beyond
    ``segment`` characters are encoded in pieces by several tasks; the pieces
    of one document meet again in one task, which holds that document only.
    """
    want = list(want)
    extra = ", ".join(f"{w} {KINDS[w]}" for w in want)
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema.fields)
    rows = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def whole(batches):
        codec = Codec.of(tokenizer)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                ids = codec.encode_all(part.column(len(keep)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], *_columns(ids, codec, want).values()], [*keep, *want])

    def cut(batches):
        codec = Codec.of(tokenizer)
        for b in batches:
            for r in range(b.num_rows):
                one = b.slice(r, 1)
                pieces = codec.segments(one.column(len(keep) + 1)[0].as_py(), segment)
                for k, p in enumerate(pieces):
                    yield pa.RecordBatch.from_arrays([*one.columns[:len(keep) + 1], pa.array([k], pa.int32()), pa.array([p])], [*keep, "_key", "_k", "_piece"])

    def piece(batches):
        codec = Codec.of(tokenizer)
        for b in batches:
            for at in range(0, b.num_rows, 16):
                part = b.slice(at, 16)
                ids = codec.encode_all(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.binary())], [*part.schema.names, "_ids"])

    def merge(table: pa.Table) -> pa.Table:
        codec = Codec.of(tokenizer)
        table = table.sort_by("_k")
        k = np.asarray(table.column("_k"))
        first = np.unique(k, return_index=True)[1]
        nodes = list(zip(table.column("_piece").take(first).to_pylist(), table.column("_ids").take(first).to_pylist()))
        made = _columns([codec.tree(nodes)], codec, want)
        same = table.select(keep).slice(0, int((k == 0).sum()))  # rows equal in id and text share their pieces
        for w in want:
            same = same.append_column(w, pa.concat_arrays([made[w]] * same.num_rows) if same.num_rows > 1 else made[w])
        return same

    short = rows.where(F.length("_text") <= segment).mapInArrow(whole, kinds + extra)
    long = rows.where(F.length("_text") > segment).select(*keep, F.xxhash64(*keep, "_text").alias("_key"), "_text")
    cells = (long.mapInArrow(cut, kinds + "_key long, _k int, _piece string").repartition("_key", "_k")
             .mapInArrow(piece, kinds + "_key long, _k int, _piece string, _ids binary"))
    return short.unionAll(cells.groupBy("_key").applyInArrow(merge, kinds + extra))


def decode(rows: DataFrame, tokenizer: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` and the text of their token ids as column ``decoded`` (null ids: null)."""
    names = rows.columns

    def run(batches):
        codec = Codec.of(tokenizer)
        for b in batches:
            at = b.schema.get_field_index(ids_col)
            text = [None if x.as_py() is None else codec.decode_ids(np.array(x.as_py(), np.int64)) for x in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string())], [*names, "decoded"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields)
    return rows.mapInArrow(run, kinds + "decoded string")
