"""The corpus pipeline against a brute-force version of its stages, on documents with planted faults."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from .test_operators import brute_components, brute_distance, text

corpus_pipeline = pytest.importorskip("corpus_pipeline")
INSULT = "quazzlemork"


def planted():
    """(doc_id, text) and what each is: toxic ones, lines that documents share, near copies, benchmark passages, and clean ones."""
    rng = random.Random(31)
    item = text(rng, 12)
    shared = "this line stands in very many of the documents"
    rows, toxic = [], set()
    for i in range(0, 240, 4):
        base = text(rng, 120)
        near = base.split()
        near[5] = "changed"
        rows += [(i, base + "\n" + shared), (i + 1, text(rng, 60) + "\n" + text(rng, 9))]
        rows.append((i + 2, (" ".join(near) if i % 8 else base) + "\n" + text(rng, 3)))
        if i % 3 == 0:
            rows.append((i + 3, text(rng, 30) + f" {INSULT} " + text(rng, 30)))
            toxic.add(i + 3)
        elif i % 3 == 1:
            broken = list(item)
            broken[7] = "#"
            rows.append((i + 3, text(rng, 40) + " " + "".join(broken) + " " + text(rng, 5)))
    rows += [(900, ""), (901, None), (902, "x"), (903, text(rng, 3000))]
    return rows, toxic, [(1, item), (2, text(rng, 12)), (3, None)]


def brute(rows, toxic, items):
    from quillmill.llm import decontaminate, tokencount  # noqa: F401
    from tokenizers import Tokenizer

    rows = [(i, t or "") for i, t in rows if i not in toxic]
    holders = {}
    for i, t in rows:
        for k in {x.strip(" \t\n\x0b\x0c\r").lower() for x in t.split("\n")}:
            holders.setdefault(k, set()).add(i)
    gone = lambda i, x: len(k := x.strip(" \t\n\x0b\x0c\r").lower()) >= 20 and len(holders[k]) >= 3 and i != max(holders[k])
    rows = [(i, "\n".join(x for x in t.split("\n") if not gone(i, x))) for i, t in rows]

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = {i: shingles(t) for i, t in rows}
    roots = brute_components(sets, lambda a, b: bool(a) and len(a & b) >= 0.8 * len(a | b))
    rows = [(i, t) for i, t in rows if roots[i] == i]
    normal = lambda t: " ".join(t.lower().split())
    held = [normal(x) for _, x in items if x and x.strip()]
    rows = [(i, t) for i, t in rows if all(brute_distance(x, normal(t)) > int(0.1 * len(x)) for x in held)]
    tokenizer, out = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), set()
    for i, t in rows:
        n = len(tokenizer.encode(t, add_special_tokens=False).ids) + 1
        out |= {(i, k, at, min(4096, n - at)) for k, at in enumerate(range(0, n, 4096))}
    return out


def test_pipeline_is_brute_force(spark, tmp_path):
    rows, toxic, items = planted()
    sf = str(tmp_path)
    docs = spark.createDataFrame([(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i, _ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    got = corpus_pipeline.run(spark, sf)
    assert {(r["doc_id"], r["piece"], r["start"], r["length"]) for r in got.collect()} == brute(rows, toxic, items)
    used = got.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n"), F.count("*")).first()
    assert used[0] <= 4096 and used[1] <= -(-got.agg(F.sum("length")).first()[0] // 4096) + 1
    stage = docs
    for _, f in corpus_pipeline.STAGES[:-1]:
        stage = f(spark, stage, sf)
        assert stage.columns == docs.columns
