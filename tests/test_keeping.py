"""What is kept from run to run: keyed tables, streams, ordered sinks, guarded writes, rounds of repair; and walks through JSON."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from quillmill.functions import walk
from quillmill.operators import chat, prediction, split
from quillmill.plans import incremental, scorers
from quillmill.plans.keyed import KeyedTable
from quillmill.sources import files, store
from quillmill.streaming import resume


def rows_of(spark, rows, schema="k long, n int, t string"):
    return spark.createDataFrame(rows, schema)


# --- keyed tables


def test_merges_keep_the_best_and_touch_few_buckets(spark, tmp_path):
    kept = KeyedTable(spark, str(tmp_path / "t"), ("k",), ("n",), buckets=8)
    with pytest.raises(FileNotFoundError):
        kept.read()
    assert kept.merge(rows_of(spark, [(i, 1, "a") for i in range(100)] + [(5, 3, "b"), (5, 2, "c")])) == 102
    before = kept.state()["buckets"]
    assert kept.merge(rows_of(spark, [(5, 1, "worse"), (6, 9, "better"), (None, 1, "null key")])) == 3
    after = kept.state()
    assert 0 < sum(before.get(b) != p for b, p in after["buckets"].items()) <= 3 and after["n_merged"] == 105
    got = {r["k"]: (r["n"], r["t"]) for r in kept.read().collect()}
    assert len(got) == 101 and got[5] == (3, "b") and got[6] == (9, "better") and got[None] == (1, "null key")
    assert kept.merge(rows_of(spark, [])) == 0 and kept.read().count() == 101
    kept.vacuum()
    assert kept.read().count() == 101 and len(store.names(spark, kept.path + "/_manifest")) == 1


def test_a_batch_merged_twice_changes_nothing(spark, tmp_path):
    kept = KeyedTable(spark, str(tmp_path / "t"), ("k",), ("n",), buckets=4)
    new = rows_of(spark, [(1, 1, "x"), (2, 1, "y")])
    assert (kept.merge(new, "w", 0), kept.merge(new, "w", 0), kept.merge(new, "other", 0)) == (2, 0, 2)
    state = kept.state()
    assert kept.merge(new, "w", 0) == 0 and kept.state() == state and kept.read().count() == 2


def test_a_failed_merge_leaves_the_table(spark, tmp_path):
    kept = KeyedTable(spark, str(tmp_path / "t"), ("k",), ("n",), buckets=4)
    kept.merge(rows_of(spark, [(1, 1, "x")]))
    fails = rows_of(spark, [(1, 5, "x")]).withColumn("t", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        kept.merge(fails)
    assert [tuple(r) for r in kept.read().select("k", "n", "t").collect()] == [(1, 1, "x")]
    # Two writers that start from one state: the second is told to merge again.
    second = KeyedTable(spark, kept.path, ("k",), ("n",), buckets=4)
    stale = second.state()
    kept.merge(rows_of(spark, [(2, 1, "y")]))
    object.__setattr__(second, "state", lambda: stale)
    with pytest.raises(RuntimeError, match="merge again"):
        second.merge(rows_of(spark, [(3, 1, "z")]))
    assert sorted(r["k"] for r in kept.read().collect()) == [1, 2]


def test_ties_and_new_columns(spark, tmp_path):
    """Rows that tie in all that is better are told apart alike in any order; a column that comes later is null in older rows."""
    tied = [(1, 1, c) for c in "abcdef"]
    out = set()
    for k in range(3):
        random.Random(k).shuffle(tied)
        kept = KeyedTable(spark, str(tmp_path / f"t{k}"), ("k",), ("n",), buckets=2)
        for r in tied:
            kept.merge(rows_of(spark, [r]))
        out.add(kept.read().first()["t"])
    assert len(out) == 1
    kept.merge(spark.createDataFrame([(2, 1, "x", 7.5)], "k long, n int, t string, more double"))
    assert sorted((r["k"], r["more"]) for r in kept.read().collect()) == [(1, None), (2, 7.5)]


# --- streams


def test_stream_resumes(spark, tmp_path):
    source, mark = (str(tmp_path / x) for x in ("in", "mark"))
    kept = KeyedTable(spark, str(tmp_path / "out"), ("id",), buckets=2)
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long").withColumn("ts", F.timestamp_seconds(F.col("id") * 60 + 1_700_000_000))
    step = lambda df: resume.fresh(df, ["id"], "ts", "10 days").withColumn("y", F.col("id") * 2)
    run = lambda: resume.run_available(spark, source, "id long, ts timestamp", step, kept, mark)
    rows(0, 1, 2, 3, 3).write.parquet(source)
    assert (run(), run()) == (4, 0)
    rows(2, 3, 4, 5).write.mode("append").parquet(source)
    assert run() == 2
    assert sorted((r["id"], r["y"]) for r in kept.read().collect()) == [(i, 2 * i) for i in range(6)]


def test_stream_batch_comes_again(spark, tmp_path):
    """A batch that was merged, though the stream's own note of it was lost."""
    source = str(tmp_path / "in")
    spark.range(5).write.parquet(source)
    kept = KeyedTable(spark, str(tmp_path / "out"), ("id",), buckets=2)
    for mark in ("one", "two"):  # the second starts from nothing and numbers its batches anew
        resume.run_available(spark, source, "id long", lambda df: df, kept, str(tmp_path / mark))
    assert kept.read().count() == 5 and kept.state()["n_merged"] == 5


# --- sinks


def test_ordered_files(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, 1, 2, 3]), f"é{i}") for i in range(257)]
    want = [r[2] for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))]
    path = str(tmp_path / "out")
    manifest = prediction.write_in_order(rows_of(spark, rows).repartition(5), path, ["n", "k"], per_file=50)
    assert sorted((r["file"], r["n_rows"], r["first"], r["last"]) for r in manifest.collect()) == [(f, 50 if f < 5 else 7, 0, 49 if f < 5 else 6) for f in range(6)]
    got = sorted(((r["file"], r["place"], r["t"]) for r in prediction.read_in_order(spark, path, "t string").collect()))
    assert [t for *_, t in got] == want and [(f, p) for f, p, _ in got] == [(i // 50, i % 50) for i in range(257)]
    store.remove(spark, f"{path}/file=2")
    with pytest.raises(ValueError, match="file 2"):
        prediction.read_in_order(spark, path, "t string")
    assert split.numbered(rows_of(spark, []), ["k"]).count() == 0


def test_guarded_writes(spark, tmp_path):
    path, rows = str(tmp_path / "out"), rows_of(spark, [(1, 1, "a"), (2, 2, "b")])
    count = {"n": F.count(F.lit(1)), "high": F.count_if(F.col("n") > 1)}
    assert files.write_guarded(rows, path, count, lambda c: None, F.col("n") > 1) == {"n": 2, "high": 1}
    with pytest.raises(ValueError, match="too many"):
        files.write_guarded(rows, path, count, lambda c: "too many" if c["n"] > 1 else None)
    assert [r["k"] for r in spark.read.parquet(path).collect()] == [2] and store.names(spark, str(tmp_path)) == ["out"]
    assert store.names(spark, str(tmp_path / "none")) == []


def test_scratch_is_swept(spark):
    files.sweep(spark)
    held = [scorers.held(spark.range(n)) for n in (2, 3)]
    assert [d.count() for d in held] == [2, 3]
    folders = [d.inputFiles()[0].rpartition("/")[0] for d in held]
    assert files.sweep(spark) == 2 and not any(store.exists(spark, f) for f in folders) and files.sweep(spark) == 0


def test_small_tools(spark):
    from quillmill.functions import text
    from quillmill.operators import facts

    assert spark.range(1).select(text.shortened(F.lit("日本語x"), 3)).first()[0] == "日本語"
    assert [chat.accumulation_steps(*x) for x in ((32, 2, 4), (33, 2, 4), (1, 8, 8))] == [4, 5, 1]
    names = spark.createDataFrame([(["a", "b", "a", "a", None, "b"],)], "x array<string>").select(facts.numbered_names(F.col("x"))).first()[0]
    assert names == ["a", "b", "a [2]", "a [3]", None, "b [2]"]
    words = {"Two MEN stand": True, "women": True, "the_man": False, "amen": False, "man2": False, "(Người)": True, "": False}
    df = spark.createDataFrame([(w,) for w in words], "t string")
    got = {r["t"]: r["y"] for r in df.select("t", facts.has_word(facts.parted(F.col("t")), facts.PERSON_WORDS).alias("y")).collect()}
    assert got == words == {r["t"]: r["y"] for r in df.select("t", F.col("t").rlike(facts.whole_words(facts.PERSON_WORDS)).alias("y")).collect()}


def test_first_words_are_the_first_of_all(spark):
    from quillmill.functions.text import words
    from quillmill.operators.facts import first_words

    rng = random.Random(3)
    rows = ["".join(rng.choice(["a", "bc", " ", "  ", "\t", "\u00a0", "\u3000", "\n"]) for _ in range(rng.randrange(14))) for _ in range(200)]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    for n in (1, 3, 6):
        assert all(r["x"] == r["y"] for r in df.select(first_words(F.col("t"), n).alias("x"), F.slice(words(F.col("t")), 1, n).alias("y")).collect())


def test_matched_and_kept_in_one_pass(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "id string, n int")
    out, missing = incremental.matched(rows, spark.createDataFrame([("a", 9)], "id string, m int"))
    assert [tuple(r) for r in out.collect()] == [("a", 1, 9)] and missing == 2
    encoded = spark.createDataFrame([(None, 3, True), ("bad", 0, False), (None, 9000, False)], "error string, n_tokens int, keep boolean")
    kept, seen = chat.kept_rows(encoded)
    assert kept.count() == 1 and seen == {"valid": 1, "invalid": 1, "too_long": 1}
    with pytest.raises(ValueError, match="no valid row"):
        chat.kept_rows(encoded.where("not keep"), str(tmp_path / "none"))
    assert not store.exists(spark, str(tmp_path / "none"))


def test_jsonl_in_one_pass(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"id": "a", "n": 1}\n\n  \n{"id": "b"}\n')
    assert sorted(tuple(r) for r in files.read_jsonl(spark, str(path), "id string, n int").collect()) == [("a", 1), ("b", None)]
    path.write_text('{"id": "a"}\n\nnot\n')
    with pytest.raises(ValueError, match=r"x\.jsonl:3: not JSON: not"):
        files.read_jsonl(spark, str(path), "id string, n int")


# --- JSON of any depth


def python_nodes(value, path=""):
    yield path, value
    if isinstance(value, dict):
        for k, v in value.items():
            yield from python_nodes(v, f"{path}.{k}" if path else k)
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from python_nodes(v, f"{path}[{i}]")


def python_without(value, keys):
    if isinstance(value, dict):
        return {k: python_without(v, keys) for k, v in value.items() if k not in keys}
    return [python_without(v, keys) for v in value] if isinstance(value, list) else value


def test_walks_are_plain_recursion(spark):
    rng = random.Random(6)

    def made(depth):
        kind = rng.random()
        if depth and kind < 0.4:
            return {rng.choice(["a", "b", "bbox", "é k", 'q"', "color_palette", "key", "pos"]): made(depth - 1) for _ in range(rng.randrange(4))}
        if depth and kind < 0.7:
            return [made(depth - 1) for _ in range(rng.randrange(4))]
        return rng.choice([None, 1, -2.5, "text", "", "日 \\ \" \n", True, False])

    docs = [made(5) for _ in range(60)] + [None, [], {}, [[[[[[[None]]]]]]]]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(900, "{no"), (901, None), (902, "")], "key long, text string")
    found = walk.walk(df, "key", "text")
    nodes = {i: dict(python_nodes(d)) for i, d in enumerate(docs)}
    assert sorted((r["key"], r["path"]) for r in found.null_paths().collect()) == sorted((i, p or "<root>") for i, n in nodes.items() for p, v in n.items() if v is None)
    assert sorted((r["key"], r["name"]) for r in found.keys().collect()) == sorted({(i, k) for i, n in nodes.items() for v in n.values() if isinstance(v, dict) for k in v})
    text = lambda v: None if v is None else str(v).lower() if isinstance(v, bool) else str(v)
    assert sorted(((r["key"], r["path"], r["value"]) for r in found.leaves().collect()), key=repr) == sorted(((i, p, text(v)) for i, n in nodes.items() for p, v in n.items() if not isinstance(v, (dict, list))), key=repr)
    for keys in ((), ("bbox", "color_palette", "a")):
        got = {r["key"]: json.loads(r["json"]) for r in walk.without_keys(df, "key", "text", keys).collect()}
        assert got == {i: python_without(d, keys) for i, d in enumerate(docs)}


@pytest.mark.parametrize(("a", "b", "same"), [('{"a":1,"b":{"c":[1,{"e":2,"d":3}]}}', '{ "b":{"c":[1,{"d":3,"e":2}]},"a":1.0}', True), ('{"a":[1,2]}', '{"a":[2,1]}', False), ('{"a":null}', "{}", False), ('{"a":"1"}', '{"a":1}', False), ('{"a":0.10}', '{"a":0.1}', True)])
def test_canonical_text(spark, a, b, same):
    r = spark.createDataFrame([(a, b)], "a string, b string").select(incremental.canonical(F.col("a")) == incremental.canonical(F.col("b"))).first()
    assert r[0] is same


def test_fingerprints_follow_values_not_order(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    inner = lambda *c: F.struct(*c).alias("i")
    one, two, three = (incremental.fingerprint(*p) for p in ((F.col("a"), inner("a", "b")), (inner("b", "a"), F.col("a")), (F.col("a"), inner("a", F.lit("y").alias("b")))))
    assert tuple(df.select(one == two, one == three).first()) == (True, False)


# --- answers


def test_calls_overlap_and_keep_their_order(spark):
    rows = spark.range(24).coalesce(1).select("id", chat.messages(F.lit("s"), F.col("id").cast("string")).alias("messages"))

    def make():
        def ask(messages):
            n = int(messages[-1]["content"])
            time.sleep(0.3 if n % 5 else 0.1)
            if n % 7 == 3:
                raise ValueError(f"no {n}")
            return f"said {n}"

        return ask

    took, got = {}, {}
    for workers in (1, 6):
        began = time.perf_counter()
        got[workers] = [tuple(r) for r in scorers.score(rows, make, "id", workers=workers).collect()]
        took[workers] = time.perf_counter() - began
    assert got[1] == got[6] == [(i, None if i % 7 == 3 else f"said {i}", f"ValueError: no {i}" if i % 7 == 3 else None) for i in range(24)]
    assert took[6] < 0.6 * took[1]


def test_calls_are_paced():
    began = time.monotonic()
    assert list(scorers.in_window(lambda x: x, range(8), 4, scorers.paced(20))) == list(range(8))
    assert time.monotonic() - began > 0.3


def test_rounds_ask_once_and_go_on(spark, tmp_path):
    """A call is made once a row and round, whatever is read; a second run with the same table asks only what is left."""
    log = tmp_path / "calls"
    log.mkdir()

    def make(refuse=False):
        def ask(messages):
            n, tries = int(messages[1]["content"]), sum(m["role"] == "assistant" for m in messages)
            (log / f"{n}-{tries}-{random.SystemRandom().getrandbits(60)}").touch()
            if n == 4:
                raise ValueError("refused")
            return "x" * (5 if tries >= n else (3 - tries))

        return ask

    rows = spark.range(5).select("id", chat.messages(F.lit("s"), F.col("id").cast("string")).alias("messages"))
    check = lambda raw: F.when(F.char_length(raw) < 5, F.array(F.lit("short"))).otherwise(F.array().cast("array<string>"))
    kept = KeyedTable(spark, str(tmp_path / "kept"), ("id",), ("attempt",), buckets=4)
    run = lambda rounds: scorers.repaired(rows, make, "id", check, chat.repair_message, rounds, kept, worth=F.char_length)
    calls = lambda: sorted(tuple(map(int, p.name.split("-")[:2])) for p in log.iterdir())
    run(1)
    assert calls() == [(i, 0) for i in range(5)]
    done = run(3)
    done.count()
    got = {r["id"]: r for r in done.collect()}
    assert calls() == [(0, 0), (1, 0), (1, 1), (2, 0), (2, 1), (2, 2), (3, 0), (3, 1), (3, 2), (4, 0)]
    assert [(got[i]["attempt"], got[i]["errors"], got[i]["raw_output"]) for i in range(3)] == [(i + 1, [], "xxxxx") for i in range(3)]
    assert (got[3]["attempt"], got[3]["raw_output"], got[3]["errors"], got[3]["why"]["message"]) == (1, "xxx", ["short"], "errors remain")  # the best of 3, 2 and 1 letters
    assert got[4]["error"] == "ValueError: refused" and got[4]["why"]["errors"] == ["ValueError: refused"] and got[0]["why"] is None
    assert run(3).count() == 5 and len(calls()) == 10


def test_token_masks_are_a_plain_loop(spark):
    from public_tokenizers import path as tokenizer_path
    from tokenizers import Tokenizer

    name = tokenizer_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(name)
    rows = [(1, "Say it.", "be brief", '{"a": "naïve 日本"}'), (2, "  ", "s", "x"), (3, "<|endoftext|> raw", "s", ""), (4, "word " * 400, "s", "y " * 300)]
    df = spark.createDataFrame(rows, "k long, user_prompt string, system string, target string")
    out = {r["k"]: r for r in chat.encode_rows(df, chat.token_ids(name), most=600).collect()}
    tokenizer.encode_special_tokens = True
    ids = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    for k, user, system, target in rows:
        if not user.strip():
            assert out[k]["error"] == "empty prompt" and out[k]["input_ids"] is None
            continue
        head = f"<|system|>\n{system}\n<|user|>\n{user.strip()}\n<|assistant|>\n<think>\n\n</think>\n\n"
        prefix, full = ids(head), ids(f"{head}{target}\n")
        assert out[k]["input_ids"] == full and out[k]["labels"] == [-100] * len(prefix) + full[len(prefix) :] and out[k]["keep"] == (len(full) <= 600)
    none = spark.createDataFrame([(None,)], "t string").select(chat.token_ids(name)(F.col("t")).alias("x")).first()
    assert none["x"] is None
