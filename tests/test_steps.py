import json

import pytest
from pyspark.sql import functions as F

from quillmill import schemas
from quillmill.operators import chat, gate, prediction, selection, split
from quillmill.plans import catalog, curation, incremental, scorers
from quillmill.sources import chat_http, config, files

INPUT = {
    "high_level_description": "h",
    "chu_de_chinh": ["tea"],
    "medium": "photograph",
    "groups": [
        {"name": "pot", "cultural": False, "cardinality": "exact:2", "so_luong": "số lượng: 2", "elements": [["a pot", "brown"], ["a lid"]]},
        {"name": "ao dai", "cultural": True, "cardinality": "exact:1", "so_luong": None, "elements": [["a dress"]]},
    ],
    "background": ["a wall", "a window"],
    "style": [{"field": "photo", "facts": ["close"]}],
}


def level(groups, background=(), style=(), medium=False):
    return {"groups": [{"name": n, "facts": list(f)} for n, f in groups], "background": list(background), "style": [{"field": k, "facts": list(f)} for k, f in style], "medium": medium}


GOOD = {
    "short": level([("pot", ["a pot"])]),
    "medium": level([("pot", ["a pot", "brown"])], ["a wall"]),
    "long": level([("pot", ["a pot", "brown", "số lượng: 2"]), ("ao dai", [])], ["a wall", "a window"], [("photo", ["close"])], True),
}


def evaluated(spark, selection_):
    schema = f"struct<s: struct<short: {schemas.CHOICE}, medium: {schemas.CHOICE}, long: {schemas.CHOICE}>, i: {schemas.SELECTION_INPUT}>"
    as_choice = {k: selection_.get(k) for k in ("short", "medium", "long")}
    raw = spark.createDataFrame([(json.dumps({"s": as_choice, "i": INPUT}),)], "t string").select(F.from_json("t", schema).alias("x")).select("x.*", F.lit("id1").alias("id"))
    return selection.evaluate(raw, "s", "i")


def changed(**levels):
    return {**json.loads(json.dumps(GOOD)), **levels}


def test_good_selection(spark):
    df = evaluated(spark, GOOD)
    row = df.first()
    assert row["errors"] == [] and row["levels"] == ["short", "medium", "long"] and row["dropped"] == []
    rows = {r["detail_level"]: r for r in selection.assemble(df).collect()}
    assert rows["long"]["checklist"] == ["tea", "a pot", "brown", "số lượng: 2", "ao dai", "a wall", "a window", "close", "photograph"]
    assert rows["short"]["checklist"] == ["tea", "a pot"] and rows["short"]["required_facts"] == ["tea"]
    assert [g["so_nhieu"] for g in rows["long"]["groups"]] == [False, False]
    assert [g["so_nhieu"] for g in rows["short"]["groups"]] == [True]


@pytest.mark.parametrize(
    ("levels", "kept", "say"),
    [
        ({"short": level([("cup", [])])}, ["medium", "long"], "unknown group cup"),
        ({"short": level([("pot", ["a pot"]), ("pot", ["a pot"])])}, ["medium", "long"], "chosen twice"),
        ({"short": level([("pot", ["red"])])}, ["medium", "long"], "strange facts red"),
        ({"short": level([("pot", [])])}, ["medium", "long"], "group without facts pot"),
        ({"short": level([("pot", ["a pot"])], style=[("photo", ["close"])])}, ["medium", "long"], "has style"),
        ({"short": level([("pot", ["a pot", "brown", "số lượng: 2"])], ["a wall"])}, ["medium", "long"], "ideas, over 2"),
        ({"medium": level([("pot", ["a pot"])], ["roof"])}, ["short", "long"], "strange facts roof"),
        ({"medium": level([("pot", ["a lid"])])}, ["short", "long"], "lacks"),
        ({"long": None}, ["short", "medium"], "long: missing"),
        ({"medium": level([("pot", ["a pot"])], style=[("lighting", ["x"])])}, ["short", "long"], "unknown style field"),
    ],
)
def test_faults_drop_their_level_alone(spark, levels, kept, say):
    row = evaluated(spark, changed(**levels)).first()
    assert row["levels"] == kept
    assert any(say in e for e in row["errors"])


def test_long_level_has_every_fact(spark):
    """However many facts a group has."""
    group = {**INPUT["groups"][0], "elements": [[f"fact {i} {k}" for k in range(3)] for i in range(500)]}
    given = spark.createDataFrame([(json.dumps({**INPUT, "groups": [group]}),)], "t string").select(F.from_json("t", schemas.SELECTION_INPUT).alias("i"))
    got = given.select(curation.rule_selection(F.col("i"))["long"]["groups"][0]["facts"].alias("facts")).first()["facts"]
    assert got == [f for e in group["elements"] for f in e]


def test_gate(spark):
    rows = [
        ("a", '[{"menh_de":"x","muc_do":"phu"}]', "[]", ["y"], True),
        ("b", '[{"menh_de":"y","muc_do":"phu"}]', "[]", ["y"], False),
        ("c", '["z", " "]', "[]", [], False),
        ("d", "[]", '[{"thong_tin":"t","muc_do":"cam_nhan"}]', [], True),
        ("e", "[]", '["t"]', [], False),
        ("f", None, None, [], True),
    ]
    df = spark.createDataFrame(rows, "k string, m string, e string, r array<string>, want boolean")
    d = df.withColumn("d", gate.decide(gate.missing_items(F.col("m")), gate.extra_items(F.col("e")), F.col("r")))
    assert all(r["d"]["passed"] == r["want"] for r in d.collect())
    assert {r["k"]: r["d"]["reasons"] for r in d.where("k = 'b'").collect()}["b"] == ["theme lost: y"]


def test_split_is_by_group_and_whole(spark):
    ids = spark.range(200).select((F.col("id") % 97).cast("string").alias("id"))
    got = {r["id"]: r["split"] for r in split.assign(ids, "id", val=10, test=20).collect()}
    assert len(got) == 97 and sorted(got.values()).count("val") == 10 and list(got.values()).count("test") == 20
    assert split.split_sizes(1, 700, 700) == (1, 1) and split.split_sizes(50, 700, 700) == (5, 5) and split.split_sizes(25, val_ratio=0.1, test_ratio=0.1) == (2, 2)


def test_numbered_is_the_order(spark):
    df = split.numbered(spark.range(500).select((F.col("id") * 37 % 500).alias("v")).repartition(7), ["v"])
    assert [r["ord"] for r in df.orderBy("v").collect()] == list(range(500))


def test_masks_and_batches(spark):
    df = spark.createDataFrame([(1, [1, 2], [1, 2, 3]), (1, [1], [1, 5, 6, 7])], "b int, p array<int>, f array<int>").select("b", chat.masked(F.col("p"), F.col("f")).alias("x")).select("b", "x.*")
    padded = chat.pad_batches(df.drop("attention_mask"), "b")
    assert {len(r["input_ids"]) for r in padded.collect()} == {8}
    assert chat.supervised_lengths(padded, "b").first()["suffix"] == 8
    with pytest.raises(Exception, match="does not begin"):
        spark.createDataFrame([([9], [1, 2])], "p array<int>, f array<int>").select(chat.masked(F.col("p"), F.col("f"))).collect()


def test_unknown_level_fails(spark):
    prompts = spark.createDataFrame([("short", "s")], "level string, system string")
    with pytest.raises(Exception, match="no system prompt"):
        chat.with_system(spark.createDataFrame([("odd",)], "mode string"), prompts).collect()


def test_repair_rounds_shrink(spark):
    def make():
        return lambda messages: "good" if len(messages) > 3 or messages[0]["content"] == "easy" else "bad"

    rows = spark.createDataFrame([("1", [("user", "easy")]), ("2", [("user", "hard")]), ("3", [("user", "hard")])], f"k string, messages {schemas.MESSAGES}")
    out = scorers.repaired(rows, make, "k", lambda raw: F.when(raw == "bad", F.array(F.lit("is bad"))).otherwise(F.array().cast("array<string>")), chat.repair_message, 3)
    got = {r["k"]: (r["raw_output"], r["attempt"]) for r in out.collect()}
    assert got == {"1": ("good", 1), "2": ("good", 3), "3": ("good", 3)}


def test_http_scorer_retries(spark):
    answers = [(500, "down"), (200, "{}"), (200, '{"choices":[{"message":{"content":"hi"}}]}')]
    naps = []
    ask = chat_http.client("http://x/v1", "m", send=lambda *a: answers.pop(0), sleep=naps.append)
    assert ask([{"role": "user", "content": "q"}]) == "hi" and len(naps) == 2
    with pytest.raises(chat_http.ScoreError, match="refused"):
        chat_http.client("http://x", "m", send=lambda *a: (401, "no"), sleep=naps.append)([])
    assert chat_http.endpoint("http://x") == "http://x/v1/chat/completions"


def test_settings():
    assert config.parse_env("# c\nexport A='1'\nB = \"x y\"\nbad\n=z") == {"A": "1", "B": "x y"}
    s = config.Settings({"LLM_BASE_URL": "u", "LLM_MODEL": "m", "LLM_API_KEY": "k", "JUDGE_MODEL": "j"})
    assert s.judge()["LLM_MODEL"] == "j" and s.judge()["LLM_API_KEY"] == "k" and s.number("N", 4) == 4
    with pytest.raises(KeyError):
        s.require("N")


def test_catalog():
    done = []
    run = catalog.Run({k: (lambda k=k: done.append(k)) for k in catalog.ORDER})
    assert run("2a") == ["2a", "2b", "2c", "2d"] and run("2c", {"2b2"}) == ["2c", "2d"]
    assert catalog.resolve(None, "out", "step0", "t.jsonl") == "out/step0_normalized/t.jsonl"
    with pytest.raises(KeyError):
        catalog.step_folder("out", "x")


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a.txt").write_text('{"x":1}\n')
    (tmp_path / "docs" / "b.json").write_text("[1]")
    (tmp_path / "docs" / "c.md").write_text("no")
    docs = files.documents(spark, str(tmp_path / "docs"))
    good, bad = files.parsed(docs)
    assert [r["id"] for r in good.collect()] == ["a"] and [r["id"] for r in bad.collect()] == ["b"]
    assert files.write_jsonl(docs, str(tmp_path / "out")) == 2
    rows = files.read_jsonl_rows(spark, str(tmp_path / "out"), ["text"], "id string")
    assert rows.count() == 2
    with pytest.raises(ValueError, match="no .txt"):
        (tmp_path / "none").mkdir()
        files.documents(spark, str(tmp_path / "none"))


def test_incremental(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, fingerprint string")
    cache = spark.createDataFrame([(1, "a", 3), (2, "old", 3), (3, "c", 2)], "k int, fingerprint string, n int")
    assert {r["k"] for r in incremental.todo(rows, cache, ["k"]).collect()} == {2}
    assert {r["k"] for r in incremental.todo(rows, cache, ["k"], retry=F.col("n") < 3).collect()} == {2, 3}
    best = incremental.newest(cache.unionByName(spark.createDataFrame([(1, "a", 1)], cache.schema)), ["k"], [F.col("n")])
    assert {r["k"]: r["n"] for r in best.collect()} == {1: 3, 2: 3, 3: 2}


def test_hard_stops_and_small_tools(spark, tmp_path):
    """What fails a call rather than giving an empty result, and helpers of a run."""
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int")
    with pytest.raises(ValueError, match="none of|no id"):
        incremental.matched(rows, spark.createDataFrame([("z", 1)], "id string, m int"))
    with pytest.raises(ValueError, match="no valid row"):
        chat.kept_rows(rows.select(F.lit("bad").alias("error"), F.lit(False).alias("keep")))
    with pytest.raises(ValueError, match="at least one"):
        prediction.variants(False, False)
    assert prediction.variants(True, True) == ["adapter", "baseline"]
    path = tmp_path / "x.jsonl"
    path.write_text('{"id": "a"}\n\n{"id": \n')
    with pytest.raises(ValueError, match=r"x\.jsonl:3: not JSON"):
        files.read_jsonl(spark, str(path), "id string")
    assert files.read_jsonl(spark, str(path), "id string", check=False).schema.simpleString() == "struct<id:string>"
    assert json.loads(files.write_config(spark, {"seed": 3407, "prompts": {"short": "x"}}, str(tmp_path / "config")))["seed"] == 3407
    assert [chat.as_ids(x) for x in ([1, 2], {"input_ids": [[3]]}, (4,))] == [[1, 2], [3], [4]]
    own = spark.createDataFrame([("write", "short", "mine")], "stage string, level string, system string")
    found = {(r["stage"], r["level"]): (r["system"], r["origin"]) for r in curation.instructions(spark, own).collect()}
    assert found["write", "short"] == ("mine", "own") and found["judge", None][1] == "default" and len(found) == len(curation.INSTRUCTIONS)
    asked = rows.select("id", chat.messages(F.lit("s"), F.col("id")).alias("messages"))
    assert [r["role"] for r in scorers.preview(asked).collect()] == ["system", "user"]
    made = rows.select(curation.write_messages(F.lit("s"), F.struct("id", F.lit(None).cast("string").alias("gone")), [("in", "out")]).alias("m")).first()["m"]
    assert [m["content"] for m in made][:3] == ["s", "in", "out"] and json.loads(made[3]["content"]) in ({"id": "a"}, {"id": "b"})


def test_scorers_batch(spark):
    """A batch that fails is asked again row by row, so that only its bad rows have errors."""

    class Many:
        def __call__(self, messages):
            if messages[-1]["content"] == "7":
                raise ValueError("seven")
            return messages[-1]["content"] + "!"

        def many(self, lists):
            return [self(m) for m in lists]

    rows = spark.range(20).select("id", chat.messages(F.lit("s"), F.col("id").cast("string")).alias("messages"))
    got = {r["id"]: (r["raw_output"], r["error"]) for r in scorers.score(rows, Many, "id", batch=6).collect()}
    assert got == {i: (f"{i}!", None) if i != 7 else (None, "ValueError: seven") for i in range(20)}
