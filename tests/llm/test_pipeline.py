"""The pipeline on the smallest documents, stage by stage, against plain Python."""

import struct
import zlib

import corpus_pipeline
from footfall.llm import packing, quality
from tests.llm import test_decontaminate, test_ngram_join, test_suffix_dedup

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 110 AND n_chars < 3000")  # plain Python is slow
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "decontamination", "packing"]
    kept, plain = docs, None
    for name, stage in corpus_pipeline.STAGES:
        before = rows_of(kept)
        out = stage(spark, kept, SF)
        path = str(tmp_path / name)
        out.write.parquet(path)
        kept = spark.read.parquet(path)
        if name == "packing":
            break
        assert kept.columns == COLUMNS
        got = rows_of(kept)
        if name == "quality":
            score = {r["doc_id"]: r["score"] for r in quality.digest(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
            plain = [r for r in before if score[r[0]] >= 0.7]
        elif name == "near_duplicates":
            first = {i for i, _, c in test_ngram_join.plain(before) if c == i}
            plain = [r for r in before if r[0] in first]
        elif name == "repeated_passages":
            want = {i: (n, removed) for i, n, removed, *_ in test_suffix_dedup.plain(before)}
            old = dict(before)
            assert [i for i, _ in got] == [i for i, _ in before]
            for i, text in got:
                n, removed = want[str(i)]
                assert len(text.encode()) <= n - removed and (removed or text == old[i])
            plain = got
        else:
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            gone = [r for r in before if r not in got]
            assert {d for d, _ in test_decontaminate.plain(gone, items)} == {i for i, _ in gone}
            some = [r for r in got if len(r[1]) < 1500][:12]
            assert not test_decontaminate.plain(some, items)
            plain = got
        assert got == plain
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_vocabulary())
    want = []
    for i, text in before:
        ids = tok.encode(text, add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want.append((i, k // 4096, k, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    assert sorted(tuple(r) for r in kept.select("doc_id", "piece", "start", "length", "ids_crc32").collect()) == sorted(want)


def test_stages_on_awkward_rows(spark, tmp_path):
    """Nulls, empty and repeated rows, a very long text and clashing column names pass through every stage; so does an empty table."""
    kind = "doc_id long, text string, lang string, source string, n_chars long, score string, _row long, row string, length int"
    good = next(r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect() if 400 < r["n_chars"] < 900)
    texts = [None, "", " ", good, good, "é " * 9, good + " " + "tail word " * 30_000]
    rows = [(i, t, "en", None, 1, "s", 2, None, 3) for i, t in enumerate(texts)] + [(3, good, "en", "b", None, "x", 5, "y", 6), (None, good, None, None, None, None, None, None, None)]
    for docs in (spark.createDataFrame(rows, kind), spark.createDataFrame([], kind)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == "packing" or out.columns == docs.columns
            n = out.count()
            assert n <= max(len(rows), 1) or name == "packing"
            assert docs.columns or n == 0
            if docs.isEmpty():
                assert n == 0
