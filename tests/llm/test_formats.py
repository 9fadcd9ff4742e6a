"""Fingerprints, chat, shards, WARC and packing against plain Python."""

import base64
import hashlib
import re
import struct
import zlib
from collections import defaultdict

import pytest
import xxhash

from footfall.llm import chat, fingerprint, packing, shards, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, _t string, n_chars long, bundle string"


def documents(spark, texts):
    rows = [(i, t, "en", "clash", 1, "clash") for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


EDGE = [
    (5, None), (3, ""), (9, "one two three"), (2, "one  two\tthree"), (11, "a b c d e f g"), (7, "a b c d e f g"),
    (8, " ".join(f"w{i}" for i in range(3000))), (1, "é" * 50), (4, "x" * 20000), (None, "nobody"),
]


def words(t):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").lower()) if w]


def h64(*longs, seed=42):
    for v in longs:
        seed = xxhash.xxh64(struct.pack("<q", v), seed=seed).intdigest()
    return seed - (1 << 64) if seed >> 63 else seed


def h32(v, seed):
    return xxhash.xxh64(struct.pack("<i", v), seed=seed).intdigest()


def plain_fingerprint(t):
    hashes = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in words(t)]
    signed = [x - (1 << 64) if x >> 63 else x for x in hashes]
    n = len(signed)
    if not n:
        return ""
    def chain(vals, seed=42):
        for v in vals:
            seed = xxhash.xxh64(struct.pack("<q", v), seed=seed).intdigest()
        return seed - (1 << 64) if seed >> 63 else seed
    if n >= 5:
        grams = {chain(signed[i : i + 5]) for i in range(n - 4)}
    else:
        s = n
        for v in signed:
            s = chain([s, v])
        grams = {s}
    bins = {}
    for g in grams:
        b = (g >> 56) + 128
        bins[b] = min(g, bins.get(b, g))
    def two(i, j):
        x = xxhash.xxh64(struct.pack("<i", j), seed=xxhash.xxh64(struct.pack("<i", i), seed=42).intdigest()).intdigest()
        return x - (1 << 64) if x >> 63 else x
    def two_long(i, j):
        x = xxhash.xxh64(struct.pack("<q", j), seed=xxhash.xxh64(struct.pack("<i", i), seed=42).intdigest()).intdigest()
        return x - (1 << 64) if x >> 63 else x
    out = []
    for i in range(256):
        v = bins.get(i)
        if v is None:
            for a in range(fingerprint.TRIES):
                v = bins.get(two(i, a) % 256)
                if v is not None:
                    break
            else:
                v = min((two_long(i, b), x) for b, x in bins.items())[1]
        out.append(f"{v & 255:02x}")
    return "".join(out)


def plain_edited(rows):
    """doc_id -> edited text, for distinct ids."""
    ids = sorted((i for i, _ in rows if i is not None), reverse=True)
    text = {i: t or "" for i, t in rows}
    out = {}
    for k, i in enumerate(ids):
        half = len(text[i]) // 2
        out[i] = text[i][: len(text[i]) - half] + text[ids[(k + 1) % len(ids)]][:half]
    return out


def check_fingerprints(df, rows):
    got = {r["doc_id"]: r for r in fingerprint.compare_with_next(df).collect()}
    edited = plain_edited(rows)
    ids = sorted((i for i, _ in rows if i is not None), reverse=True)
    assert len(got) == len(rows)
    for k, i in enumerate(ids):
        r, t = got[i], dict(rows)[i]
        assert r["n_chars"] == len(t or "")
        assert r["edited_sha256"] == hashlib.sha256(edited[i].encode()).hexdigest()
        assert r["fingerprint"] == plain_fingerprint(t)
        assert r["edited_fingerprint"] == plain_fingerprint(edited[i])
        assert 0 <= r["near_edited"] <= 1
        if ids[(k + 1) % len(ids)] != i and plain_fingerprint(t) == plain_fingerprint(dict(rows)[ids[(k + 1) % len(ids)]]):
            assert r["near_next"] == 1.0
    return got


def test_fingerprints_edge_cases(spark):
    got = check_fingerprints(documents(spark, EDGE), EDGE)
    assert got[None]["near_next"] == 0.0 and got[None]["edited_sha256"] == hashlib.sha256(b"nob").hexdigest()
    assert fingerprint.compare_with_next(documents(spark, [])).collect() == []
    twice = fingerprint.compare_with_next(documents(spark, [(1, "a b"), (1, "a b"), (2, "c d")])).collect()
    assert len(twice) == 3


def test_fingerprints_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "ROWS_PER_BUCKET", 7)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60").collect()]
    check_fingerprints(documents(spark, rows), rows)


def test_likeness_follows_jaccard(spark):
    base = [f"w{i}" for i in range(2000)]
    rows = []
    for k in range(1, 10):
        changed = [("x" + w if i % (12 * k) == 0 else w) for i, w in enumerate(base)]
        rows += [(f"{k}", " ".join(base), " ".join(changed))]
    df = spark.createDataFrame(rows, "k string, a string, b string")
    df = fingerprint.fingerprints(df, {"fa": "a", "fb": "b"}).select("a", "b", fingerprint.likeness(fingerprint.F.col("fa"), fingerprint.F.col("fb")).alias("j"))
    for r in df.collect():
        sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (words(r["a"]), words(r["b"]))]
        assert abs(r["j"] - len(sets[0] & sets[1]) / len(sets[0] | sets[1])) < 0.13


TALK = "conv_id long, turn long, role string, text string, formatted string"


def plain_talks(rows):
    talks = defaultdict(list)
    for c, n, role, text in rows:
        talks[c].append((n is not None, n or 0, role or "", text or ""))
    out = {}
    for c, turns in talks.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha(said), len(loss), sha(loss))
    return out


HARD = [
    (1, 0, "user", "\\### Assistant: </turn> ok"), (1, 1, "assistant", "\\### Assistant: </turn> ok"),
    (2, 0, "user", "a\\e\\t\\h\\c"), (2, 1, "assistant", None), (2, 2, "assistant", "\n"), (2, 3, None, " </turn>\n### User: x </turn>\n"),
    (3, 0, "us: er", " x "), (3, 1, "assistant", "ends with </turn"), (3, None, "assistant", ""), (3, 1, "assistant", "ends with </turn"),
    (None, 0, "assistant", "é\r\n\t###"), (4, 0, "</turn>", "###"), (4, 1, "a###\\", "\\"), (5, 0, "assistant", "x" * 100000),
]


def test_chat_round_trip(spark):
    rows = HARD + [(r["conv_id"] + 100, r["turn"], r["role"], r["text"]) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    df = spark.createDataFrame([(*r, "clash") for r in rows], TALK)
    out = chat.format_conversations(df)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digest(out).collect()}
    assert got == plain_talks(rows)
    for r in out.collect():
        assert len(r["loss_spans"]) == sum(t["role"] == "assistant" for t in r["turns"])
    assert chat.digest(chat.format_conversations(df.limit(0))).collect() == []


def test_plain_text_is_not_escaped(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi \\ there", "")], TALK)
    assert chat.format_conversations(df).first()["formatted"] == "### user: hi \\ there </turn>\n"


def test_shards_fit(spark):
    rows = [(i, "x" * (i % 50)) for i in range(2000)] + [(77, "y" * 30)] * 500 + [(9000, "z" * 5000), (None, None), (9001, "")]
    rows += [(1, "w" * 1500)] * 3 + [(1, "w" * 1600)]
    got = shards.assign(documents(spark, rows), limit=1000).collect()
    assert sorted((r["doc_id"] or -1, r["n_bytes"]) for r in got) == sorted((i or -1, len(t or "")) for i, t in rows)
    size, prefix = defaultdict(int), set()
    for r in got:
        size[(r["kind"], r["depth"], r["prefix"], r["piece"])] += r["n_bytes"]
        if r["kind"] == "hash":
            prefix.add((r["depth"], r["prefix"]))
    assert all(s <= 1000 for k, s in size.items() if k[0] != "row")
    single = [(r["depth"], r["prefix"], r["piece"]) for r in got if r["kind"] == "row"]
    assert len(single) == len(set(single)) == 5
    assert [k for k in size if k[0] == "row"] and [k for k in size if k[0] == "key"]
    for d, p in prefix:  # no shard inside another, and none could have been joined with its sibling
        assert not any((e, p >> (d - e)) in prefix for e in range(d))
    sums = {(k[1], k[2]): s for k, s in size.items() if k[0] == "hash"}
    for (d, p), s in sums.items():
        if d and (d, p ^ 1) in sums:
            assert s + sums[(d, p ^ 1)] > 1000
    assert shards.assign(documents(spark, [])).collect() == []


PAGES = "page_id long, url string, html string, refers string, bundle string"


def test_warc_round_trip(spark, tmp_path):
    rows = [
        (3, "http://a/%41?x=é", "<p>same</p>"), (1, "http://b/ c", "<p>same</p>"), (2, "u\r\nv", ""), (4, None, None), (5, "http://c", "x" * 3_000_000),
        (None, "http://d", "<p>same</p>"), (6, " s ", "é\r\n\r\nWARC/1.1"), (6, " s ", "é\r\n\r\nWARC/1.1"), (None, "e", "only"),
    ]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES)
    index, records = warc.archive(df, str(tmp_path / "warc"))
    got = records.collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, u, h in rows:
        lead = first.get(h or "")
        back = None if lead is None or lead == i else lead
        data = (h or "").encode()
        want.append((str(i), u or "", len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if back is not None else "response", str(back), b"" if back is not None else data))
    have = [(str(r["page_id"]), r["url"], r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"]), bytes(r["payload"])) for r in got]
    assert sorted(have) == sorted(want)
    for r in index.collect():
        head, _ = warc.lookup(str(tmp_path / "warc"), r["bundle"], r["frame"], r["offset"])
        assert head["WARC-Record-ID"] == r["record_id"]
    _, none = warc.archive(df.limit(0), str(tmp_path / "none"))
    assert none.collect() == []


def test_warc_reads_the_payload_itself(tmp_path):
    import pyarrow as pa

    digest = base64.b32encode(hashlib.sha1(b"right").digest()).decode()
    whole = warc._record(1, "u", b"right", digest, None)
    bundle = warc._Bundle()
    bundle.add((1, "a"), whole)
    bundle.add((2, "b"), whole.replace(b"right", b"wrong"))
    bundle.add((3, "c"), whole.replace(b"Content-Length: 5", b"Content-Length: 4").replace(b"right", b"righ"))
    bundle.add((4, "d"), warc._record(4, "u", b"right", digest, 1))
    name, _ = bundle.write(str(tmp_path))
    frames = warc._frames([pa.RecordBatch.from_arrays([pa.array([name])], names=["bundle"])], str(tmp_path))
    got = [r for b in warc._read(frames, str(tmp_path), False) for r in b.to_pylist()]
    of = lambda x: (len(x), base64.b32encode(hashlib.sha1(x).digest()).decode())
    assert [(r["payload_bytes"], r["payload_digest"]) for r in got] == [of(b"right"), of(b"wrong"), of(b"righ"), of(b"right")]
    assert {r["payload"] for r in got} == {None}


def test_packing(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_vocabulary())
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(1000, None), (1001, ""), (1002, "don't STOP_it'S 12½ ﬁ Σας İ́ \x1c  <|endoftext|>"), (1003, "w " * 9000), (1003, "w " * 9000), (None, "null id")]
    got = packing.pack_documents(documents(spark, rows)).collect()
    want = []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want.append((str(i), k // 4096, k, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], zlib.crc32(bytes(r["ids"]))) for r in got) == sorted(want)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in bins.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 4096
    total = sum(w[3] for w in want)
    assert len(bins) <= -(-total // 4096) + 1
    assert packing.pack_documents(documents(spark, [])).collect() == []


def test_plan_stays_small():
    """The broadcast plan depends on the sequence length and not on the number of pieces."""
    sizes = [len(packing.plan({n: 1 + (n * 7919) % k for n in range(1, 4097)})) for k in (100, 10_000, 1_000_000)]
    assert max(sizes) < 20_000


def test_split_follows_the_word_rule(spark):
    import random

    rng = random.Random(4)
    alphabet = "ab'stmdrevl_09 \t\n.,-\"éßÀº«×ÿȺɄƁ–„"
    texts = ["", " ", "'", "''s", "it's", "'sam", "x'rex'll'", "9's'9", "a_b", "don't 'T we'Ve"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts = [t.lower() for t in texts if packing.PLAIN.fullmatch(t)]
    assert len(texts) > 3000
    first, words = packing.split(texts)
    words = words.to_pylist()
    for text, a, b in zip(texts, first[:-1].tolist(), first[1:].tolist(), strict=True):
        assert words[a:b] == packing.WORD.findall(text)
    assert packing.split([])[0].tolist() == [0]


def test_word_cache_trims(monkeypatch):
    """A cache of a few words gives what the tokenizer gives, and keeps the words used most."""
    import random

    monkeypatch.setattr(packing, "CACHE_WORDS", 40)
    words = packing.Words(packing.default_vocabulary())
    rng = random.Random(2)
    for _ in range(30):
        texts = [" ".join(["the", "often"] + [f"w{rng.randint(0, 400)}x's" for _ in range(rng.randint(0, 12))]) for _ in range(5)] + ["", "The<|endoftext|>"]
        for text, ids in zip(texts, words.encode(texts), strict=True):
            assert ids.tolist() == words.whole(text).tolist()
    assert {"the", "often"} <= set(words.number) and len(words.number) < 200


@pytest.mark.parametrize("seed", range(5))
def test_plan_is_best_fit_decreasing(seed):
    """As many sequences as best-fit decreasing over single documents."""
    import random
    from bisect import bisect_left, insort

    rng = random.Random(seed)
    lengths = sorted((rng.choice([64, rng.randint(1, 64), rng.randint(20, 40)]) for _ in range(700)), reverse=True)
    room = []  # free lengths, sorted
    opened = 0
    for n in lengths:
        at = bisect_left(room, n)
        if at == len(room):
            opened += 1
            insort(room, 64 - n)
        else:
            insort(room, room.pop(at) - n)
    counts = {n: lengths.count(n) for n in set(lengths)}
    used = {seq + (r - lo) // per for _, lo, hi, seq, _, per in packing.plan(counts, 64) for r in range(lo, hi)}
    assert len(used) == opened


@pytest.mark.parametrize("seed", range(20))
def test_plan_places_every_piece(seed):
    import random

    rng = random.Random(seed)
    counts = {rng.randint(1, 64): rng.randint(1, 60) for _ in range(rng.randint(1, 40))}
    used, ranks = defaultdict(list), defaultdict(list)
    for length, lo, hi, seq, at, per in packing.plan(counts, 64):
        for r in range(lo, hi):
            ranks[length].append(r)
            used[seq + (r - lo) // per].append((at + (r - lo) % per * length, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(v)) for k, v in counts.items()}
    for spans in used.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 64
    assert sorted(used) == list(range(len(used)))
