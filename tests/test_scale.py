"""Work that must follow its input: documents of very many elements, and what a step does but once."""

import time

from pyspark.sql import functions as F

from quillmill.queries import QUERIES


def long_documents(spark, folder, lines: int):
    rows = [(1, "\n".join(["head", "ground", *(f"a thing {i}, red" for i in range(lines))]), "en", "src1", 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_orphan_elements_takes_a_document_of_many_elements(spark, tmp_path):
    folder, began = long_documents(spark, tmp_path, 1500), time.monotonic()
    row = QUERIES["orphan_elements"](spark, folder).first()
    assert row["n_elements"] == 1500 and row["orphans"] == ",".join(str(i) for i in range(1500) if i % 3)
    assert time.monotonic() - began < 40  # groups were built anew for each element and looked through for each name


def test_decomposition_validate_tells_an_element_once(spark, tmp_path):
    df = QUERIES["decomposition_validate"](spark, long_documents(spark, tmp_path, 5))
    assert df.first()["errors"] == ""
    assert df._jdf.queryExecution().optimizedPlan().toString().count("tourists") <= 2  # the lists of words stood in the plan for each use of an element's kind


def test_token_ids_go_to_the_tokenizer_in_portions(spark, monkeypatch):
    import pandas as pd

    from quillmill.operators import chat

    class Encoding:
        def __init__(self, text):
            self.ids = list(range(len(text) % 7))

    class Tokenizer:
        most = 0

        def encode_batch(self, texts, add_special_tokens):
            Tokenizer.most = max(Tokenizer.most, sum(map(len, texts)) if len(texts) > 1 else 0)
            return [Encoding(t) for t in texts]

    monkeypatch.setattr(chat, "_tokenizer", lambda path: Tokenizer())
    texts = pd.Series(["x" * (i % 3000) if i % 5 else None for i in range(2000)] + ["y" * 500_000])
    got = chat.token_ids("none").func(texts)
    assert [None if x is None else list(x) for x in got] == [None if t is None else list(range(len(t) % 7)) for t in texts]
    assert 0 < Tokenizer.most <= 200_000  # all texts of a batch went at once


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_prompt_row_merge_chooses_once(spark, tmp_path):
    df = QUERIES["prompt_row_merge"](spark, long_documents(spark, tmp_path, 5))
    assert df.count() > 0
    assert "Generate" not in plan(df)  # both sides of the join chose facts anew


def test_writer_and_judge_writes_each_message_once(spark, tmp_path):
    df = QUERIES["writer_and_judge"](spark, long_documents(spark, tmp_path, 5))
    assert {r["judged"] for r in df.collect()} == {"checklist"}
    assert plan(df).count("Write.") == 1  # a message was written for each look at it


def test_status_of_training_rows_moves_no_target(spark):
    from quillmill.operators import split

    of = lambda ids, kind, more: spark.createDataFrame([(i, *more) for i in ids], kind)
    passed, splits = of("abc", "id string, detail_level string", ("long",)), of("abc", "id string, split string", ("train",))
    targets = spark.createDataFrame([("a", "said"), ("b", None)], "id string, target_json string")
    parts = ", ".join(f"{c} string" for c in ("chu_de_chinh", "groups", "background", "style", "medium", "checklist"))
    rows = split.training_rows(passed, targets, of("ab", f"id string, detail_level string, {parts}", ("long", *"xxxxxx")), splits)
    assert {r["id"]: r["status"] for r in rows.collect()} == {"a": "ok", "b": "no target", "c": "no target"}
    lines = [x for x in plan(rows.select("id", "status")).splitlines() if "isnotnull(" in x and "Join" not in x]
    assert any("AS _target" in x for x in lines)  # told before the join; the target itself went through all joins


def test_the_driver_fits_no_machine(spark, monkeypatch):
    """What the fit's matrices take stays out of the driver, beside which other stages run."""
    import os

    import numpy as np

    from quillmill.llm import toxicity

    rng = np.random.default_rng(7)
    windows = [rng.integers(1, 27, toxicity.WINDOW, dtype=np.uint8).tobytes() for _ in range(40)]
    weights, bias = toxicity.machine(windows[:15], windows[15:])
    driver, machine = os.getpid(), toxicity.machine

    def elsewhere(positive, negative):
        assert os.getpid() != driver
        return machine(positive, negative)

    monkeypatch.setattr(toxicity, "machine", elsewhere)
    got, at = toxicity.machine_by_task(spark, windows[:15], windows[15:])
    assert np.array_equal(got, weights) and at == bias
    # A fit comes to its end without one in the driver.
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    docs = [(i, f"ordinary words {word()} {'zorkblat' if i % 3 == 0 else word()} {word()} of a plain day.") for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in docs], "doc_id bigint, toxic int")
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id bigint, text string"), labels)
    assert model is not None and np.isfinite(model[0]).all()


def test_sets_come_packed(spark):
    import numpy as np

    from quillmill.llm import simhash

    rows = [(7, [3, -1, 5]), (-2, []), (1, [9])]
    nodes, ends, elements = simhash.packed_sets(spark.createDataFrame(rows, "node bigint, hashes array<bigint>").repartition(3))
    assert nodes.tolist() == [-2, 1, 7] and ends.tolist() == [0, 0, 1, 4]
    assert elements.dtype == np.uint64 and elements.view(np.int64).tolist() == [9, 3, -1, 5]
    none = simhash.packed_sets(spark.createDataFrame([], "node bigint, hashes array<bigint>"))
    assert [len(x) for x in none] == [0, 1, 0]
    # Two texts whose sets are alike, met by a word, and one that is not.
    held = spark.createDataFrame([(0, 5, 1, 1), (0, 5, 2, 2), (0, 5, 3, 3)], "tab int, word bigint, node bigint, root bigint")
    sets = simhash.packed_sets(spark.createDataFrame([(1, list(range(10))), (2, list(range(9))), (3, list(range(50, 60)))], "node bigint, hashes array<bigint>"))
    assert [tuple(r) for r in simhash.bucket_links(held, sets, 0.8).collect()] == [(1, 2)]


def test_the_machine_travels_without_its_zeros(spark, monkeypatch):
    """Each machine went to the tasks and came to the driver as a table of 21 MB."""
    import pickle

    import numpy as np
    from pyspark import SparkContext

    from quillmill.llm import toxicity

    weights = np.zeros(toxicity.CODES**toxicity.ORDER, np.float32)
    weights[[5, 7_000, len(weights) - 1]] = 1.5, -2, 3
    assert np.array_equal(toxicity.unpacked(*toxicity.packed(weights)), weights)
    sizes, broadcast = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: (sizes.append(len(pickle.dumps(value))), broadcast(self, value))[1])
    docs = spark.createDataFrame([(i, f"ordinary words of {'a zorkblat' if i % 3 == 0 else 'some'} kind, {'abcdefgh'[i % 8 :]} on day {i}.") for i in range(90)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id bigint, toxic int")
    assert {r["doc_id"] for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()} == set(range(0, 90, 3))
    assert toxicity.keep_clean(docs, labels).count() == 60
    assert len(sizes) > 4 and max(sizes) < 1_000_000


def test_telling_runs_are_chosen_as_from_a_full_table(spark):
    """Runs are taken one by one, and rows that hold enough of them count no more."""
    import numpy as np

    from quillmill.llm import toxicity

    rng = np.random.default_rng(3)
    names = ["zorkblat", "quuxfrob", "plughity", "wibblest", "frobnice"]
    word = lambda: "".join(rng.choice(list("abcdefghij"), 7))
    text = lambda k: f"{word()} {' '.join(f'{x} {word()}' for x in k)} {word()}."
    frame = lambda rows: spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    toxic, clean = [text(rng.choice(names, rng.integers(1, 4))) for _ in range(60)], [text([word(), word()]) for _ in range(120)]
    for times in (1, 3, 10):
        got = toxicity.telling_runs(frame(toxic), frame(clean), 60, 121, times=times)
        runs = lambda x: {r for n in toxicity.LENGTHS for r in toxicity.runs(toxicity.sentences([x.encode()])[0], n).tolist() if r >= 0}
        holds, others = [runs(x) for x in toxic], [runs(x) for x in clean]
        found, left = [], [times] * 60
        while True:
            live = {}
            for r in sorted(set().union(*holds) - set(found)):
                t, c = sum(r in h for h, n in zip(holds, left, strict=True) if n > 0), sum(r in o for o in others)
                full = sum(r in h for h in holds)
                gain = lambda t, c=c: t * np.log(t / (60 * max((t + c) / 181, 1 / 181))) + c * np.log(max(c, 1) / (121 * max((t + c) / 181, 1 / 181)))
                if full >= 13 and t >= 3 and t / 60 > 20 * c / 121 and gain(t) > 14:
                    live[r] = gain(t)
            if not live:
                break
            best = max(live.values())
            k = min(r for r in live if live[r] == best)
            found.append(k)
            left = [n - (k in h) for n, h in zip(left, holds, strict=True)]
        assert got.tolist() == sorted(found)


def test_finalize_report_moves_no_document_that_it_joins_anyway(spark, tmp_path):
    folder = long_documents(spark, tmp_path, 5)
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    df = QUERIES["finalize_report"](spark, folder)
    assert "Repartition" not in plan(df)  # each look at the documents dealt their texts to all tasks first


def test_a_walk_moves_and_writes_a_text_but_once(spark):
    from quillmill.functions import walk

    rows = spark.createDataFrame([("a", '{"p": {"q": [{"r": {"s": [1, {"bbox": [2]}, {}, [], "two"]}}, null], "t": "three"}}'), ("b", "7"), ("c", "[]"), ("d", '{"bbox": 1}')], "key string, text string")
    found = walk.walk(rows, "key", "text")
    for n, level in enumerate(found.levels):
        held = level.where("kind in ('object', 'array')")
        assert held.where("value is not null").count() == (0 if n % walk.HOPS else held.count())  # each level held all that lay below it
    assert len(found.levels) == 9 and {r["path"] for r in found.leaves().where("key = 'a'").collect()} == {"p.q[0].r.s[0]", "p.q[0].r.s[1].bbox[0]", "p.q[0].r.s[4]", "p.q[1]", "p.t"}
    bare = walk.without_keys(rows, "key", "text")
    assert {r["key"]: r["json"] for r in bare.collect()} == {"a": '{"p":{"q":[{"r":{"s":[1,{},{},[],"two"]}},null],"t":"three"}}', "b": "7", "c": "[]", "d": "{}"}
    physical = bare._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in physical and physical.count("Exchange hashpartitioning") == physical.count("REPARTITION_BY_NUM")  # texts were dealt anew at each level


def test_cleaning_a_decomposition_ranks_each_list_once(spark):
    from quillmill import schemas
    from quillmill.operators import facts

    row = ([(None, " b "), (0, "a"), (1, " ")], None, None, {"0": [(2, "color", "y"), (1, "odd", "x")]}, [(3, None, "far"), (3, None, "near"), (0, None, None)], {"photo": [(5, "wide")], "medium": [(0, "no")]})
    df = spark.createDataFrame([(row,)], f"d {schemas.DECOMPOSITION}").select(facts.normalise_decomposition(F.col("d")).alias("d"))
    d = df.first()["d"].asDict(recursive=True)
    texts = lambda xs: [(x["rank"], x["text"]) for x in xs]
    assert (texts(d["chu_de_chinh"]), texts(d["facts"]["0"]), texts(d["background_facts"]), texts(d["style_facts"]["photo"])) == ([(0, "a"), (1, "b")], [(0, "x"), (1, "y")], [(0, "far"), (1, "near")], [(0, "wide")])
    assert [x["kind"] for x in d["facts"]["0"]] == ["attribute", "color"] and d["field_priority"] == {"elements": 1, "background": 1, "photo": 1}
    assert plan(df).count("sort_array") == 4  # the background and the style were ranked three times, each pair compared by an expression


def test_even_texts_are_cut_as_patterns_cut_them(spark):
    from quillmill.operators import facts

    wanted = {"The red  Lamp , lit . , a b c d e f g.. with LEFT side": ["red lamp ", "lit", "a b c d e f", "left side"], "An old lamp lit; blue. featuring two tops": ["old lamp lit;", "blue", "two tops"], "a with featuring b, On Top": ["with featuring b", "featuring b", "on top"], "x\u00a0y, z\tw  v": ["x y, z", "z w v"], "": [facts.NOTHING], "the": ["the"]}
    rows = spark.createDataFrame([(t,) for t in wanted], "t string").select("t", facts.rule_facts(F.col("t")).alias("f"), facts.even(F.col("t")).alias("e")).collect()
    assert {r["t"]: [f["text"] for f in r["f"]] for r in rows} == wanted
    assert {r["t"]: [f["kind"] for f in r["f"]] for r in rows}["a with featuring b, On Top"] == ["subject", "attribute", "position"]
    assert [r["t"] for r in rows if not r["e"]] == ["The red  Lamp , lit . , a b c d e f g.. with LEFT side", "x\u00a0y, z\tw  v"]


def test_variants_travel_with_their_word_once_and_in_few_rows(spark):
    import numpy as np
    import pandas as pd

    from quillmill.llm import simhash

    held = spark.createDataFrame([(i % 28, i, i, i) for i in range(2800)], "tab int, word long, node long, root long")
    assert simhash.parts_of(held, 33) == (1, 28)  # each task wrote a row for each part of the session in each table: tables times too many
    rng, flips = np.random.default_rng(3), simhash.masks(32, 2)[0].astype(np.uint32)
    rows = pd.DataFrame({"word": rng.integers(0, 1 << 32, 500), "node": rng.integers(-9, 9, 500), "root": rng.integers(-9, 9, 500)})
    rows.loc[1] = rows.loc[0]
    want = sorted((int(w) ^ int(f), w, n, r) for w, n, r in rows.itertuples(index=False) for f in flips)
    for parts in (1, 8, 16, 17, 400):
        packed = simhash.every_variant(5, parts, flips, rows)
        got = [simhash.unpacked_variants(packed.iloc[[i]], flips, np.uint8, words=np.uint32, nodes=np.int64, roots=np.int64) for i in range(len(packed))]
        assert sorted((int(a), int(b), int(c), int(d)) for v, _, w, n, r in got for a, b, c, d in zip(v, w, n, r, strict=True)) == want
        seen = [set(v.tolist()) for v, *_ in got]
        assert sum(map(len, seen)) == len(set().union(*seen)) and len(packed) <= parts  # a variant is in one part
        size = sum(len(x) for c in ("codes", "words", "nodes", "roots", "counts") for x in packed[c])
        assert size < len(want) * (7 if parts <= 8 else 22)  # 24 bytes for each before


def test_components_compute_a_round_once(spark, monkeypatch):
    from quillmill.llm import common

    def twice(df):
        raise AssertionError("a checkpoint computes its last stage twice")

    monkeypatch.setattr(common, "checkpointed", twice)
    of = lambda rows: {tuple(r) for r in common.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert of([(i, i + 1) for i in range(9)] + [(20, 22), (22, 21), (30, 30)]) == {(i, 0) for i in range(10)} | {(i, 20) for i in (20, 21, 22)}
    assert of([]) == set()
