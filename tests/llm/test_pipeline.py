"""The pipeline's stages against brute force on the smallest tables."""

import corpus_pipeline as P
from toolloom.llm import decontaminate, simhash

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in P.STAGES:
        before, docs = docs, P.cut(stage(spark, docs, SF))
        seen[name] = (before.toPandas(), docs.toPandas())
        assert name == "packed" or docs.columns == columns
    before, after = seen["near_duplicates"]
    fp = {r.doc_id: simhash.fingerprint((r.text or "").encode()) for r in before.itertuples()}
    part = {i: i for i in fp}
    for a in fp:
        for b in fp:
            if a < b and (fp[a] ^ fp[b]).bit_count() <= 4 and part[a] != part[b]:
                x, y = part[a], part[b]
                part = {k: min(x, y) if v in (x, y) else v for k, v in part.items()}
    assert set(after["doc_id"]) == {i for i, p in part.items() if i == p}
    before, after = seen["benchmark"]
    built = [b for b in decontaminate.automata(spark.read.parquet(f"{SF}/benchmark.parquet"))]
    kept = set(after["doc_id"])
    for r, (n, hit, _) in zip(before.itertuples(), decontaminate.scan([(t or "").encode() for t in before["text"]], [b.value for b in built])):
        assert (r.doc_id in kept) == (not (hit.sum() and 20 * hit.sum() >= n))
    assert set(seen["packed"][1]["doc_id"]) == kept
    assert len(seen["language"][1]) >= 0.95 * len(seen["language"][0])
