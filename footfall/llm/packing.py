"""Best-fit packing of documents into fixed-length token sequences, planned on a length histogram.

1. Every document is tokenized once; longer ones are cut into pieces of ``MAX_TOKENS``.
2. Pieces are counted per length. Best-fit decreasing runs over the counts, on the driver: equal open
   sequences are one run (first number, how many), so the plan has a size that depends on
   ``MAX_TOKENS``, not on the documents.
3. A piece gets a rank within its length; joining on the rank gives its planned slot.

Ranks come from counts per (length, salt) plus a row number within, so a frequent length is no
hot group. Defined results: a special token's name inside a text, such as <|endoftext|>, has its one id, as the tokenizer's
defaults give it; a null text has the tokens of an empty one, the end mark alone; rows that share a doc_id are packed
each; a long text is tokenized whole and cut after; an empty table gives no pieces. Other columns are not looked at.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from footfall.llm.words import slices
from footfall.session import lean, materialize

MAX_TOKENS = 4096
END_ID = 1
SALT_ROWS = 50_000
CACHE_WORDS = 600_000
# The tokenizer's own word rule, on lower-case text of the characters in PLAIN.
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
# The same rule as classes of code points: white space, letters, digits, other.
SPACE, LETTER, DIGIT, OTHER = range(4)
# Characters whose case, class and normal form are the same in every Unicode version: printable
# ASCII, white space and Latin letters up to U+024F without superscripts, fractions and dotted capital I.
PLAIN = re.compile(r"[\t\n\r -~¡-±´-¸º»¿-įı-ǃǍ-ǰǴ-ɏ–-„]*")


def _classes() -> np.ndarray:
    """Class of every code point that a PLAIN text has in lower case."""
    kind = np.full(0x3000, OTHER, np.uint8)
    for c in range(len(kind)):
        kind[c] = SPACE if chr(c).isspace() else DIGIT if chr(c).isdecimal() else LETTER if chr(c).isalpha() else OTHER
    return kind


_CLASS = _classes()


def split(texts: list[str]) -> tuple[np.ndarray, pa.Array]:
    """(first word of every text, one more entry than texts; all words), by WORD, of lower-case PLAIN texts."""
    joined = "\n".join(texts)
    code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    kind = _CLASS[code]
    inside = kind != SPACE
    start = inside.copy()
    start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    # An apostrophe that begins a run of other characters takes s, t, m, d, re, ve or ll with it.
    quote = np.flatnonzero(start & (code == ord("'")))
    ahead = np.concatenate([code, np.zeros(2, np.uint32)])
    one, two = ahead[quote + 1], ahead[quote + 2]
    size = np.isin(one, [ord(c) for c in "stmd"]).astype(np.int64)
    for pair in ("re", "ve", "ll"):
        size[(one == ord(pair[0])) & (two == ord(pair[1]))] = 2
    hit, size = quote[size > 0], size[size > 0]
    start[hit + 1] = False
    after = hit + 1 + size
    after = after[after < len(code)]
    start[after[kind[after] == LETTER]] = True
    place = np.flatnonzero(start)
    width = (1 + (code > 0x7F) + (code > 0x7FF)).astype(np.int64)
    kept = np.frombuffer(joined.encode(), np.uint8)[np.repeat(inside, width)]
    ends = np.cumsum(width * inside)
    offsets = np.append((ends - width * inside)[place], len(kept)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(place), pa.py_buffer(offsets.tobytes()), pa.py_buffer(kept.tobytes()))
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return np.searchsorted(place, first), words


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Words:
    """Token ids of texts, through a cache of words; the tokenizer itself sees each new word once.

    One per Python worker. At ``CACHE_WORDS`` words those that were used most since the last time stay, half as many,
    which bounds its memory and keeps the frequent words known. Texts that a word rule does not fit go to the tokenizer whole.
    """

    loaded: dict[str, Words] = {}

    @classmethod
    def of(cls, path: str) -> Words:
        if path not in cls.loaded:
            cls.loaded[path] = cls(path)
        return cls.loaded[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.added = [str(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.number: dict[str, int] = {}
        self.words = 0
        self.first = np.zeros(1 << 16, np.int64)  # of each word in ids; one more entry than words
        self.ids = np.zeros(1 << 18, np.uint32)
        self.used = np.zeros(1 << 16, np.int64)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = []
        for i, text in enumerate(texts):
            if PLAIN.fullmatch(text) and not any(name in text for name in self.added):
                plain.append(i)
            else:
                out[i] = self.whole(text)
        if self.words > CACHE_WORDS:
            self._trim()
        first, words = split([texts[i].lower() for i in plain])
        coded = words.dictionary_encode()
        names, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        self._learn([w for w in names if w not in self.number])
        number = np.fromiter(map(self.number.__getitem__, names), np.int64, len(names))
        self.used[number] += np.bincount(at, minlength=len(names))
        begin = self.first[number][at]
        n = self.first[number + 1][at] - begin
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.arange(ends[-1]) + np.repeat(begin - ends[:-1], n)]
        for i, a, b in zip(plain, ends[first[:-1]].tolist(), ends[first[1:]].tolist(), strict=True):
            out[i] = ids[a:b]
        return out

    def _trim(self) -> None:
        used = self.used[: self.words]
        kept = np.sort(np.argpartition(-used, CACHE_WORDS // 2)[: CACHE_WORDS // 2])
        names = list(self.number)
        first, end = self.first[kept], self.first[kept + 1]
        parts = [self.ids[a:b] for a, b in zip(first.tolist(), end.tolist(), strict=True)]
        self.number, self.words = {}, 0
        self._add([names[k] for k in kept.tolist()], np.concatenate(parts), end - first)
        self.used[:] = 0

    def _add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, at = self.words, int(self.first[self.words]) if self.words else 0
        while len(self.first) <= n + len(words):
            self.first, self.used = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.used))
        while len(self.ids) < at + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.number.update(zip(words, range(n, n + len(words)), strict=True))
        self.words = n + len(words)
        self.ids[at : at + len(ids)] = ids
        self.first[n + 1 : self.words + 1] = at + np.cumsum(sizes)

    def _learn(self, new: list[str]) -> None:
        for i in range(0, len(new), 4000):
            part = new[i : i + 4000]
            joined = [" ".join(part[k : k + 500]) for k in range(0, len(part), 500)]
            got = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
            for k, ids in zip(range(0, len(part), 500), got, strict=True):
                some = part[k : k + 500]
                stop = np.flatnonzero(self.ends[ids]) + 1
                # A contraction such as 's may join its neighbours differently: then word by word.
                if len(stop) != len(some) or (len(ids) and stop[-1] != len(ids)):
                    each = [self.whole(w) for w in some]
                    ids, stop = np.concatenate(each), np.cumsum([len(x) for x in each])
                self._add(some, ids, np.diff(stop, prepend=0))


PIECES = "doc_id long, piece int, start long, length int, ids binary"


def tokenize(docs: DataFrame, vocabulary: str | None = None, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit) of every piece."""
    path = vocabulary or default_vocabulary()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(lean(lambda batches: _pieces(batches, path, max_tokens)), PIECES)


def _pieces(batches: Iterator[pa.RecordBatch], path: str, most: int) -> Iterator[pa.RecordBatch]:
    words = Words.of(path)
    for batch in batches:
        for a, b, _, _ in slices(batch.column(1)):
            doc, piece, start, length, data = [], [], [], [], []
            for d, ids in zip(batch.column(0)[a:b].to_pylist(), words.encode(batch.column(1)[a:b].to_pylist()), strict=True):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for k in range(0, len(ids), most):
                    part = ids[k : k + most]
                    doc.append(d)
                    piece.append(k // most)
                    start.append(k)
                    length.append(len(part))
                    data.append(part.tobytes())
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip((doc, piece, start, length, data), kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids"],
            )


def plan(counts: dict[int, int], size: int = MAX_TOKENS) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over a length histogram.

    Rows (length, first rank, end rank, first sequence, offset, per sequence): the piece of rank r takes sequence
    first + (r - first rank) // per, at offset + (r - first rank) % per * length.
    """
    slots, room, runs, fresh = [], [], {}, 0  # room: sorted free lengths; runs: free length -> [(sequence, how many)]

    def leave(free: int, sequence: int, n: int) -> None:
        if free and n:
            if free not in runs:
                runs[free] = []
                insort(room, free)
            runs[free].append((sequence, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(room, length)
            if at < len(room):
                free = room[at]
                sequence, n = runs[free].pop()
                if not runs[free]:
                    del runs[free], room[at]
            else:
                free, sequence = size, fresh
                n = -(-left // (size // length))
                fresh += n
            per = free // length
            full, rest = divmod(min(left, n * per), per)
            offset = size - free
            if full:
                slots.append((length, rank, rank + full * per, sequence, offset, per))
                leave(free - per * length, sequence, full)
            if rest:
                slots.append((length, rank + full * per, rank + full * per + rest, sequence + full, offset, per))
                leave(free - rest * length, sequence + full, 1)
            used = full + bool(rest)
            leave(free, sequence + used, n - used)
            rank += full * per + rest
            left -= full * per + rest
    return slots


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length and any others)."""
    spark = pieces.sparkSession
    total = pieces.count()
    salts = 1 + total // SALT_ROWS
    keyed = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    # At most max_tokens * salts rows; the driver sees their sums per length only.
    cells = materialize(keyed.groupBy("length", "_salt").agg(F.count("*").alias("_n")), "pack-histogram")
    counts = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    below = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = cells.withColumn("_first", F.coalesce(F.sum("_n").over(below), F.lit(0))).select("length", "_salt", "_first")
    # Rows that share doc_id and piece are told apart by the rest, so a repeated task ranks alike.
    order = ["doc_id", "piece", *(c for c in pieces.columns if c not in ("doc_id", "piece", "length"))]
    here = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*order)) - 1
    ranked = keyed.withColumn("_here", here).join(firsts, ["length", "_salt"]).withColumn("_rank", F.col("_here") + F.col("_first"))
    slots = _slots(spark, plan(counts, max_tokens))
    hit = (ranked["length"] == slots["_l"]) & (ranked["_rank"] >= slots["_lo"]) & (ranked["_rank"] < slots["_hi"])
    step = F.col("_rank") - F.col("_lo")
    # The plan's size is bounded by max_tokens alone (see plan), so it may be broadcast.
    return (
        ranked.join(F.broadcast(slots), hit)
        .withColumn("sequence_id", F.col("_seq") + F.expr("(_rank - _lo) div _per"))
        .withColumn("offset", (F.col("_at") + step % F.col("_per") * F.col("length")).cast("long"))
        .drop("_salt", "_here", "_first", "_rank", "_l", "_lo", "_hi", "_seq", "_at", "_per")
    )


def _slots(spark: SparkSession, slots: list) -> DataFrame:
    schema = "_l int, _lo long, _hi long, _seq long, _at long, _per long"
    return spark.createDataFrame(slots, schema)


def pack_documents(docs: DataFrame, vocabulary: str | None = None, payload: Column | None = None) -> DataFrame:
    """All documents packed: doc_id, piece, start, length, sequence_id, offset and the payload.

    The payload is the column ``ids``, or what an expression makes of it; only that moves with
    the lengths when pieces are ranked and placed.
    """
    tokens = materialize(tokenize(docs, vocabulary), "pack-tokens")
    return pack(tokens.select("doc_id", "piece", "start", "length", F.col("ids") if payload is None else payload))


def digest(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Contract columns: the packing with the token ids as their CRC-32."""
    return pack_documents(docs, vocabulary, F.crc32("ids").alias("ids_crc32")).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )
