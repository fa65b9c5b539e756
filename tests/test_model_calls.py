"""Calls, verdicts, generation, with transports that answer by script."""

import json
import os
import pathlib
import random
import sys
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from talkmill.operators import generate, judge, mix, refine, transport
from talkmill.sources.config import Config, ConfigError, Generation, Refinement, load


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import a test module


def body(x):
    return json.dumps({"choices": [{"message": {"content": x}}]})


class Script:
    def __init__(self, *steps):
        self.steps, self.asked = list(steps), []

    def send(self, request, timeout):
        self.asked.append(request)
        step = self.steps.pop(0)
        if isinstance(step, Exception):
            raise step
        return step


CFG = Refinement(model="m", max_retries=5)


@pytest.mark.parametrize(
    ("steps", "value", "waits"),
    [
        ([(200, body('{"a":1}'))], {"a": 1}, []),
        ([(200, body('```json\n[1]```'))], [1], []),
        ([(429, "")] * 5, None, [4, 8, 16, 32, 64]),
        ([(503, "")] * 5, None, [2, 4, 8, 16, 32]),
        ([(503, ""), (200, body("2"))], 2, [2]),
        ([(400, "")], None, []),
        ([TimeoutError(), ConnectionError(), (200, body("3"))], 3, [2, 4]),
        ([(200, body("{")), (200, body("4"))], 4, [2]),
        ([(200, "{}")], None, []),
        ([(200, body(None))], None, []),
        ([RuntimeError("x")], None, []),
    ],
)
def test_call(steps, value, waits):
    slept = []
    got = transport.call(CFG, Script(*steps), [{"role": "user", "content": "x"}], slept.append)
    assert got.value == value and slept == waits


def test_request_and_key(monkeypatch):
    monkeypatch.delenv("OPENROUTER_API_KEY", raising=False)
    with pytest.raises(ValueError):
        transport.require_key(CFG)
    assert transport.request(CFG, [])["reasoning"] == {"effort": "none"}
    assert transport.seconds(10) == 120


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        (None, (False, [], {})), ("{}", (True, [], {})), ('{"remove":null}', (False, [], {})), ('{"remove":[1,"2",2.0,true,99]}', (True, [1, 2], {})), ('{"remove":[[1]]}', (False, [], {})), ("[1]", (False, [], {})),
        ('{"remove":[false],"reasons":{"0":"x","1":"y"}}', (True, [0], {"0": "x"})), ('{"remove":[],"reasons":[]}', (True, [], {})), ('{"keep":[0],"remove":[0]}', (True, [0], {})), ('{"remove":[NaN]}', (True, [], {})), ("{", (False, [], {})),
    ],
)
def test_verdict(raw, want):
    assert refine.read_verdict(raw, 5) == want


def test_verdict_with_bad_reasons():
    with pytest.raises(refine.BadReasons):
        refine.read_verdict('{"remove":[0],"reasons":["x"]}', 5)


def chats(spark, n):
    return spark.createDataFrame([("f", i, [("user", f"p{i}"), ("assistant", f"c{i}")]) for i in range(n)], "file string, seq long, messages array<struct<role: string, content: string>>")


@pytest.mark.parametrize("n", [0, 1, 40, 41, 80])
def test_refine_batches(spark, n):
    rows = chats(spark, n)
    out = refine.refine(rows, lambda b: b.where("batch_idx = 0").select("file", "batch_idx", F.lit('{"remove":[0,0,39],"reasons":{"39":"last"}}').alias("raw")))
    assert out.count() == n
    gone = {r.global_idx: r.reason for r in refine.removed(out).collect()}
    assert gone == {k: v for k, v in {0: refine.NO_REASON, 39: "last"}.items() if k < n}
    assert refine.kept(out).count() + len(gone) == n


def test_model_judge_fails_open(spark):
    out = refine.refine(chats(spark, 3), refine.model_judge(Refinement(model="m", prompt="p", max_workers=1), Always(400, ""), sleep=no_sleep))
    assert refine.kept(out).count() == 3


class Always:
    def __init__(self, *answer):
        self.answer = answer

    def send(self, request, timeout):
        return self.answer


def no_sleep(x):
    return None


def ok(*pairs):
    return 200, body(json.dumps([{"messages": [{"role": "u", "content": a, "x": 1}, {"role": "a", "content": b}]} for a, b in pairs]))


def test_generation_loop():
    cfg = Generation(model="m", prompt="{n} of {topic} {{}}", batch_size=2)
    send = Script(ok(("a", "b")), ok(("c", " "), ("d", "e")), ok(("f", "g"), ("h", "i")))
    found, bad = generate.topic_examples(cfg, send, "t", 3, 10, no_sleep)
    assert [m[0]["content"] for _, m in found] == ["a", "d", "f"] and bad == 1
    assert [a["messages"][0]["content"] for a in send.asked] == ["2 of t {}", "2 of t {}", "1 of t {}"]
    assert generate.topic_examples(cfg, Script(*[ok()] * 4), "t", 3, 4, no_sleep) == ([], 0)
    assert len(generate.topic_examples(cfg, Script(ok(("a", "b")), (400, "")), "t", 3, 4, no_sleep)[0]) == 1
    assert generate.topic_examples(cfg, Script((200, body('{"messages":[]}')), (400, "")), "t", 3, 4, no_sleep) == ([], 0)


def test_generation_errors_stay_with_their_topic(spark):
    topics = spark.createDataFrame([(1, "good", 2), (2, "bad", 2)], "topic_idx int, topic string, count int")
    out = generate.generate(topics, Generation(model="m", prompt="{topic}", max_workers=2), Topical(), sleep=no_sleep).collect()
    assert sorted(r.topic for r in out if r.messages) == ["good", "good"]
    assert [r.topic for r in out if r.messages is None] == ["bad"]


class Topical:
    def send(self, request, timeout):
        if request["messages"][0]["content"] == "bad":
            return 400, ""
        return ok(("a", "b"), ("c", "d"))


def test_offline_judge(spark):
    rows = [("a b", "c"), ("A  b!", "C"), ("[post text]", "x"), ("q", "As an AI, I can help")]
    df = spark.createDataFrame([("f", 0, i, [("user", a), ("assistant", b)]) for i, (a, b) in enumerate(rows)], "file string, batch_idx long, i int, messages array<struct<role: string, content: string>>")
    got = {r.i: r.reason for r in judge.offline_reasons(df, ["file", "batch_idx"]).collect()}
    assert got == {0: None, 1: "duplicate in batch", 2: "placeholder text", 3: "sounds like an assistant"}


def test_offline_rules_that_are_asked_for(spark):
    words = "one two three four five six seven eight nine ten"
    rows = [(words, words), (words + " eleven", words), ("p1", "same answer"), ("p2", "Same answer!"), ("zz yy xx", "unrelated"), ("twice", "said"), ("again", "x y"), ("zq vw", "uu kk")]
    batches = [0] * 7 + [1, 1]
    rows.insert(7, ("twice", "said"))
    df = spark.createDataFrame([("f", b, i, [("user", p), ("assistant", c)]) for i, (b, (p, c)) in enumerate(zip(batches, rows))], "file string, batch_idx long, i int, messages array<struct<role: string, content: string>>")
    keys = ["file", "batch_idx"]
    why = lambda **rules: {r.i: r.reason for r in judge.offline_reasons(df, keys, **rules).collect() if r.reason}
    assert why() == {}
    assert why(near=90) == {1: "nearly a duplicate in batch"}
    assert why(generic=2) == {i: "generic comment" for i in range(4)}
    assert why(often=2) == {5: "boilerplate", 7: "boilerplate"}
    known = spark.createDataFrame([(w,) for w in f"{words} eleven p1 p2 same answer unrelated twice said again x y zz yy".split()], "word string")
    assert why(words=known, unknown=0.5) == {8: "unknown words"}
    assert set(why(unrelated=0.0)) == {2, 3, 4, 5, 6, 7, 8}
    replies = judge.offline_judge(df, generic=2)(df).collect()
    assert [json.loads(r.raw)["remove"] for r in replies] == [[0, 1, 2, 3]]


class Counting:
    """A judge whose verdicts differ from call to call, and that counts what it is asked in a file a batch."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self, batches):
        folder = self.folder

        def run(frames):
            import pandas as pd

            for frame in frames:
                raw = []
                for n in frame["n"]:
                    (pathlib.Path(folder) / uuid.uuid4().hex).touch()
                    raw.append(json.dumps({"remove": random.sample(range(int(n)), int(n) // 2)}))
                yield pd.DataFrame({"file": frame["file"], "batch_idx": frame["batch_idx"], "raw": raw})

        return batches.select("file", "batch_idx", "n").mapInPandas(run, "file string, batch_idx long, raw string")


def test_streaming_judges_each_row_once(spark, tmp_path):
    from talkmill.streaming import incremental

    for k in range(3):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "calls").mkdir(exist_ok=True)
        (tmp_path / f"in/{k}.jsonl").write_text("\n".join(json.dumps({"messages": [{"role": "user", "content": f"{k} {i}"}, {"role": "assistant", "content": "x"}], "own": i}) for i in range(50)) + "\n{\n")
    root = f"file://{tmp_path}"
    run = lambda: incremental.refine_new_files(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", Counting(str(tmp_path / "calls")), size=10)
    run()
    kept = [r.value for r in spark.read.parquet(f"{root}/out/refined").collect()]
    gone = [r.value for r in spark.read.parquet(f"{root}/out/removed").collect()]
    assert len(kept) == len(gone) == 75 and len({*kept, *gone}) == 150 and all("own" in json.loads(x) for x in gone)
    assert len(list((tmp_path / "calls").iterdir())) == 15
    run()  # nothing new
    assert len(list((tmp_path / "calls").iterdir())) == 15


class Waves:
    def __init__(self, folder, stop=None):
        self.folder, self.stop = folder, stop

    def send(self, request, timeout):
        topic = request["messages"][0]["content"]
        (pathlib.Path(self.folder) / f"{topic}-{uuid.uuid4().hex}").touch()
        if topic == self.stop:
            os.kill(os.getpid(), 9)  # a worker is lost, again and again
        return ok((topic, "b"))


def test_generation_keeps_what_its_waves_brought(spark, tmp_path):
    from talkmill import cli
    from talkmill.sources.config import Config

    (tmp_path / "calls").mkdir()
    cfg = Config({"paths": {"unprocessed_data_dir": f"file://{tmp_path}/raw"}, "generation": {"model": "m", "prompt": "{topic}", "max_workers": 2}, "topics": [{"topic": f"t{i}", "count": 1} for i in range(5)]})
    with pytest.raises(Exception):  # noqa: B017  whatever Spark makes of a lost worker
        cli.generate_command(spark, cfg, "run.jsonl", Waves(str(tmp_path / "calls"), "t2"))
    read = lambda: [json.loads(r.value)["messages"][0]["content"] for r in spark.read.text(f"file://{tmp_path}/raw/run.jsonl").collect()]
    assert read() == ["t0", "t1"]
    cli.generate_command(spark, cfg, "run.jsonl", Waves(str(tmp_path / "calls")))
    assert read() == [f"t{i}" for i in range(5)]
    calls = [p.name.split("-")[0] for p in (tmp_path / "calls").iterdir()]
    assert calls.count("t0") == calls.count("t1") == calls.count("t4") == 1
    assert not (tmp_path / "raw/.waves/run.jsonl").exists()


def test_key_from_a_file(tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    monkeypatch.delenv("OPENROUTER_API_KEY", raising=False)
    assert Generation().api_key() is None
    (tmp_path / ".env").write_text("# x\nOTHER=1 # note\nexport OPENROUTER_API_KEY='a # b' # c\nBAD\n")
    assert Generation().api_key() == "a # b"
    monkeypatch.setenv("OPENROUTER_API_KEY", "own")
    assert Generation().api_key() == "own"


@pytest.mark.parametrize("n", [0, 1, 7, 499, 999, 1000, 2000, 0.1, 0.9999])
def test_first_of_a_shuffle(spark, n):
    rows = spark.range(1000).select((F.col("id") % 600).alias("k"), "id").unionByName(spark.range(0).withColumn("k", F.col("id")))
    marked, total = mix.first_shuffled(rows, "k", n)
    want = min(1000, n if isinstance(n, int) else -int(-(n * 1000) // 1))
    got = marked.collect()
    assert total == len(got) == 1000 and sum(r._first for r in got) == want
    order = sorted(r.d for r in rows.select(mix.digest(42, F.col("k")).alias("d")).collect())
    first = marked.where("_first").select(mix.digest(42, F.col("k")).alias("d")).collect()
    assert sorted(r.d for r in first) == order[:want]


@pytest.mark.parametrize(
    ("section", "data"),
    [
        ("model", {"max_seq_length": 0}), ("cpt_training", {}), ("cpt_training", {"datasets": [{"path": "x", "probability": 0.98}]}), ("cpt_training", {"datasets": [{"path": "x", "probability": 1}], "lora_alpha": 8}),
        ("cpt_training", {"datasets": [{"path": "x", "probability": 1}], "epochs": 0}), ("cpt_training", {"datasets": [{"path": "x", "probability": 1}, {"path": "y", "probability": -0.001}]}), ("sft_training", {"eval_split": 0}),
        ("sft_training", {"eval_split": 1}), ("sft_training", {"learning_rate": 0}), ("generation", {"temperature": 2.5}), ("generation", {"max_workers": 0}), ("refinement", {"batch_size": 0}), ("generation", {"prompt": "x"}),
    ],
)
def test_config_rejects(section, data):
    with pytest.raises(ConfigError):
        Config({section: data})[section]


def test_config_reads(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text('sft_training: {learning_rate: 5e-6, unknown: 1}\ncpt_training: {datasets: [{path: a, probability: 1.005}]}\ntopics: [["x", 3], {topic: y, count: 4}]\ngeneration: {prompt: "{n}"}\n')
    c = load(str(p)).check_all()
    assert c["sft_training"].learning_rate == 5e-6 and [t.count for t in c.topics] == [3, 4]
    (tmp_path / "e.yaml").write_text("")
    assert load(str(tmp_path / "e.yaml"))["refinement"].batch_size == 40
    with pytest.raises(FileNotFoundError):
        load(str(tmp_path / "none.yaml"))
    with pytest.raises(ConfigError):
        Config()["generation"].configured()


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_shuffle_and_split_do_not_depend_on_partitions(spark, parts):
    rows = spark.range(1000).withColumnRenamed("id", "k").repartition(parts)
    pos = {r.k: r.pos for r in mix.shuffled(rows, "k").collect()}
    assert sorted(pos.values()) == list(range(1, 1001))
    assert pos == {r.k: r.pos for r in mix.shuffled(rows.coalesce(1), "k").collect()}
    assert mix.exact_split(rows, "k", 0.1001).where("split = 'eval'").count() == 101
    assert mix.exact_split(rows, "k", None).where("split = 'eval'").count() == 0
    with pytest.raises(ValueError):
        mix.take(mix.shuffled(rows, "k"), 1001, "error")


def test_weighted_mix_prefix(spark):
    rows = spark.range(4000).select((F.col("id") % 2).cast("string").alias("source_id"), F.col("id").alias("row_key"), F.lit("x").alias("text"))
    out = mix.mixed(rows, {"0": 0.75, "1": 0.25}, 1000, "weighted")
    assert abs(out.where("source_id = '0'").count() - 750) < 60
    every = mix.interleaved(rows, {"0": 0.75, "1": 0.25})
    assert every.count() == 4000 and every.select("source_id", "row_key").distinct().count() == 4000
