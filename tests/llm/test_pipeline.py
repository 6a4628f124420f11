"""The pipeline's run() on given and planted rows, each stage against plain Python on what the stage before kept; held-out accuracy."""

import hashlib
import random
import re
from array import array

from pyspark.sql import functions as F

from boundaryspark.llm import bpe, quality, queries

SMALL, NEXT = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SPACE = re.compile(r"[\x20\x09-\x0D]")


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + size]) for i in range(max(len(words) - size + 1, 1))} if words else set()


def near_kept(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[find(i)] = find(j)
    best = {}
    for i, (number, _) in enumerate(rows):
        if sets[i]:
            best.setdefault(find(i), []).append((-len(sets[i]), number))
    return {min(v)[1] for v in best.values()} | {number for i, (number, _) in enumerate(rows) if not sets[i]}


def test_run_as_plain_python(spark, tmp_path, monkeypatch):
    import corpus_pipeline
    rng = random.Random(12)
    given = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in given.collect()]
    by_id = {r[0]: r[1] for r in rows}
    good = [r for r in rows if len((r[1] or "").split()) > 80][:20]
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    number = max(by_id) + 1
    planted = {"copy": [], "near": [], "leak": []}
    for k, r in enumerate(good[:8]):
        words = r[1].split(" ")
        at = rng.randrange(20, 60)
        near = " ".join([*words[:at], "otherword", *words[at + 1:]])
        for kind, text in (("copy", r[1].replace(" ", "  ")), ("near", near), ("leak", f"{' '.join(words[:30])} {items[k]} {' '.join(words[30:])}")):
            planted[kind].append(number)
            rows.append((number, text, *r[2:]))
            number += 1
    rows.append((number, None, "en", "web", 0))
    sf_dir = str(tmp_path / "sf")
    spark.createDataFrame(rows, given.schema).repartition(4).write.parquet(f"{sf_dir}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{sf_dir}/{name}.parquet")
    kept, stage = [], corpus_pipeline.materialize

    def watched(df, name):
        out = stage(df, name)
        if name in dict(corpus_pipeline.STAGES):
            kept.append(out)
        return out
    monkeypatch.setattr(corpus_pipeline, "materialize", watched)
    last = corpus_pipeline.run(spark, sf_dir).collect()
    texts = [[(r["doc_id"], r["text"]) for r in k.collect()] for k in kept[:4]]
    assert all(k.columns == given.columns for k in kept[:4]) and len(kept) == 5
    # 1: what the classifier scores below its threshold goes
    scored = {r["doc_id"]: r["score"] for r in quality.score_texts(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), quality.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))).collect()}
    assert {n for n, _ in texts[0]} == {n for n, s in scored.items() if s >= quality.THRESHOLD}
    # 2: of equal texts the longest, then the least id
    groups = {}
    for n, t in texts[0]:
        groups.setdefault(SPACE.sub("", t or ""), []).append((-len(t or ""), n))
    assert {n for n, _ in texts[1]} == {min(g)[1] for g in groups.values()}
    # 3: one of each group of near copies
    assert {n for n, _ in texts[2]} == near_kept(texts[1])
    # 4: planted passages go, texts that share nothing with an item stay
    left = {n for n, _ in texts[3]}
    assert not left & set(planted["leak"])
    parts = set().union(*(shingles(re.sub(r"[^\w]+", " ", t.lower())) for t in items))
    assert {n for n, t in texts[2] if not parts & shingles(re.sub(r"[^\w]+", " ", (t or "").lower()))} <= left
    # 5: ids of the library
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(bpe.default_path())
    assert {r["doc_id"] for r in last} == left
    for r in last:
        ids = library.encode(dict(texts[3])[r["doc_id"]] or "", add_special_tokens=False).ids
        assert list(array("I", r["ids"])) == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_held_out_rows_are_told_apart(spark):
    rows = queries.QUERIES["op6_quality"](spark, NEXT).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{NEXT}/labels.parquet").collect()}
    unseen = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, y in unseen if y == 1], [s for s, y in unseen if y == 0]
    wins = sum((g > b) + (g == b) / 2 for g in good for b in bad)
    assert len(bad) > 3 and wins / (len(good) * len(bad)) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    assert {r["held_out"] for r in rows} == {True, False}


def test_long_and_repeated_rows_have_scores(spark):
    rows = [(1, "calm words in a row " * 60000), (1, "calm words in a row"), (1, "calm words in a row"), (2, "### $$$ buy!!")]
    docs = spark.createDataFrame([(*r, "s", 3) for r in rows], "doc_id long, text string, score string, held_out int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (1, 0)], "doc_id long, quality int")
    scored = quality.score_texts(docs, quality.train(docs, labels))
    got = sorted((r["doc_id"], len(r["text"]), r["score"]) for r in scored.collect())
    assert [g[:2] for g in got] == [(1, 19), (1, 19), (1, 1200000), (2, 13)] and got[0][2] == got[1][2] > got[3][2]
    assert scored.where(F.col("score").isNull()).count() == 0
