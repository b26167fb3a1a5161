"""The pipeline on small tables: each stage keeps the documents' columns and takes effect."""

import math
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from farfield.llm.common import stored
from farfield.llm.quality import judge


def test_stages(spark, awkward, tmp_path):
    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    spark.createDataFrame([(1, 1, 0), (2, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        docs = stored(stage(spark, docs, str(tmp_path)), name)
        if name in ("quality", "exact", "near"):
            assert docs.count() <= before
        if name != "pack":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "exact":
            assert docs.count() == docs.select("text").distinct().count() or docs.where("text IS NULL OR text = ''").count() == 1
    assert docs.count() > 0


def test_exact_stage_keeps_each_text_once(spark, awkward):
    """The rows that stay: of each text (null as empty) the one with the largest id, a null id being the smallest."""
    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    want = {}
    for r in docs.collect():
        key, i = r["text"] or "", -1 if r["doc_id"] is None else r["doc_id"]
        want[key] = max(want.get(key, -1), i)
    got = [(r["text"] or "", -1 if r["doc_id"] is None else r["doc_id"]) for r in corpus_pipeline.exact(spark, docs, "").collect()]
    assert sorted(got) == sorted(want.items())


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_near_stage_keeps_one_of_each_class(spark):
    """Against brute force over all pairs, with texts far from and well within the similarity."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(5))
    base = [[word() for _ in range(120)] for _ in range(12)]
    rows = []
    for k in range(40):
        text = list(base[k % 12])
        if k >= 12:
            text[rng.randrange(120)] = word()  # five of 116 shingles differ
        rows.append((k, " ".join(text), "en", "s", 1))
    shingles = [{tuple(words_of(r[1].lower())[i : i + 5]) for i in range(len(words_of(r[1])) - 4)} for r in rows]
    root = list(range(40))
    for i in range(40):
        for j in range(i):
            if len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near(spark, docs, "").collect()) == sorted(set(root))


def test_quality_stage_drops_what_the_classifier_rejects(spark, awkward, tmp_path):
    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    labels = [(i, int(i % 3 > 0), 0) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = Counter((r["doc_id"], r["text_hash"]) for r in judge(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).collect() if r["kept"])
    got = corpus_pipeline.quality(spark, docs, str(tmp_path)).select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    assert Counter(map(tuple, got)) == kept and 0 < len(got) < docs.count()


def test_run_by_brute_force(spark, tmp_path):
    """The last three stages of a run, counted by hand: each source's words come near its target, no document is taken
    more than twice, and all that the mix holds is packed without gaps."""
    rng = random.Random(5)
    rows = [(k, " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(200)), "en", f"s{k % 3}", 1) for k in range(90)]
    spark.createDataFrame([*rows, (200, rows[3][1], "en", "s0", 1)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, held = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, str(tmp_path)), name)
        held[name] = docs.collect()
    assert sorted(r["doc_id"] for r in held["near"]) == [k for k in range(90) if k != 3] + [200]
    texts, taken = {r["doc_id"]: r["text"] for r in held["near"]}, Counter()
    for r in held["mix"]:
        assert " ".join(words_of(r["text"])) in texts[r["doc_id"]] or set(words_of(r["text"])) <= set(words_of(texts[r["doc_id"]]))
        taken[r["doc_id"]] += len(words_of(r["text"]))
    assert all(n <= 400 for n in taken.values())
    size = Counter()
    for r in held["near"]:
        size[r["source"]] += len(words_of(r["text"]))
    target = {s: w * 1.5 * sum(size.values()) / 6 for s, w in zip(sorted(size), (3, 1, 2), strict=True)}
    spare = max(0.0, target["s0"] - 2 * size["s0"])
    target = {"s0": min(target["s0"], 2 * size["s0"]), "s1": target["s1"] + spare / 3, "s2": target["s2"] + spare * 2 / 3}
    got = Counter()
    for r in held["mix"]:
        got[r["source"]] += len(words_of(r["text"]))
    assert all(abs(got[s] - target[s]) <= 1 for s in target)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = tokenizers.Tokenizer.from_file(path)
    assert sum(p["length"] for p in pieces) == sum(len(ids.encode(r["text"], add_special_tokens=False).ids) + 1 for r in held["mix"])
    bins = defaultdict(list)
    for p in pieces:
        bins[p["sequence_id"]].append((p["offset"], p["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= math.ceil(sum(p["length"] for p in pieces) / 4096) + 1


@pytest.mark.parametrize("name", ["documents"])
def test_empty_documents(spark, nothing, tmp_path, name):
    nothing.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
