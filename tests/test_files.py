"""JSON lines, hidden names, numbering, merging, the command line."""

import json
import os

import pytest
from pyspark.sql import functions as F

from talkmill import cli
from talkmill.functions import json as js
from talkmill.functions import text as t
from talkmill.functions import tokenizers
from talkmill.operators import dedup, examples
from talkmill.sources import config, files, hub, jsonl


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return f"file://{path}"


def test_blank_lines_line_ends_and_numbers(spark, tmp_path):
    p = put(tmp_path / "lines.jsonl", '{"a":1}\n\n   \n \n\x1c\n{"a":"x y"}\r\n{"a":3}\r{"a":4}')
    rows, bad = jsonl.scan_jsonl(spark, [p])
    assert [(r.line_no, json.loads(r.value)["a"]) for r in rows.orderBy("line_no").collect()] == [(1, 1), (6, "x y"), (7, 3), (8, 4)]
    assert bad.count() == 0
    assert [r.seq for r in jsonl.with_seq(rows).orderBy("line_no").collect()] == [0, 1, 2, 3]


BAD = ['{"a":', '{"a":1} trailing', "{'a':1}", '﻿{"a":1}', '{"a":"x\ty"}', '{"a":01}']
GOOD = ['{"a":1,"a":2}', '{"a":NaN}', "5", "[1]", "null"]


def test_malformed_lines(spark, tmp_path):
    p = put(tmp_path / "bad.jsonl", "\n".join(BAD + GOOD))
    rows, bad = jsonl.scan_jsonl(spark, [p])
    assert sorted(r.value for r in rows.collect()) == sorted(GOOD)
    assert sorted(r.line_no for r in bad.collect()) == list(range(1, len(BAD) + 1))
    with pytest.raises(Exception, match="malformed JSON"):
        jsonl.scan_jsonl(spark, [p], "fail")[0].collect()


def test_numbers_over_many_splits(spark, tmp_path):
    p = put(tmp_path / "big.jsonl", "".join(json.dumps({"i": i, "x": "y" * (i % 90)}) + "\n" for i in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows, _ = jsonl.scan_jsonl(spark, [p])
        assert rows.where(F.get_json_object("value", "$.i").cast("long") != F.col("line_no") - 1).count() == 0
        assert rows.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_listing(spark, tmp_path):
    for n in ("b.jsonl", "B.jsonl", "_x.jsonl", ".y.jsonl", "c.txt"):
        put(tmp_path / "in" / n, '{"messages":[]}\n')
    folder = f"file://{tmp_path}/in"
    found = files.listed(spark, folder)
    assert [f.rsplit("/", 1)[1] for f in found] == [".y.jsonl", "B.jsonl", "_x.jsonl", "b.jsonl"]
    rows, _ = jsonl.scan_folder(spark, folder, own=f"{folder}/../in/b.jsonl".replace("/../in", ""))
    assert sorted(r.file for r in rows.collect()) == [".y.jsonl", "B.jsonl", "_x.jsonl"]
    assert files.listed(spark, f"file://{tmp_path}/none") == []
    assert jsonl.scan_folder(spark, f"file://{tmp_path}/none") is None
    assert jsonl.scan_named(spark, f"file://{tmp_path}/none.jsonl") is None


def test_merge_keeps_the_first_as_written(spark, tmp_path):
    a = ['{"b": {"y": 1, "x": "é"}, "a": 1}', '{"a":2}', '{"a":2}']
    b = ['{"a": 1, "b": {"x": "\\u00e9", "y": 1}}', '{"a": 1.0}', "7", '{"a":3}']
    put(tmp_path / "dup_a.jsonl", "\n".join(a))
    put(tmp_path / "dup_b.jsonl", "\n".join(b))
    put(tmp_path / "dup_c.jsonl", '{"a": 2}')
    rows, _ = jsonl.scan_folder(spark, f"file://{tmp_path}")
    first = dedup.merged(rows.select("file", "line_no", "value"))
    assert [r.value for r in first.orderBy("file", "line_no").collect()] == [a[0], a[1], b[1], b[2], b[3]]
    assert {r.file: r.added for r in dedup.added_by_file(rows, first).collect()} == {"dup_a.jsonl": 2, "dup_b.jsonl": 3, "dup_c.jsonl": 0}


EXAMPLES = [
    ('{"messages":[]}', False), ('{"messages":[{"role":"a","content":"x"}]}', False), ('{"messages":[{"role":"a","content":"x"},{"role":"b","content":"y"}]}', True),
    ('{"messages":null}', False), ('{"messages":"x"}', False), ('{"messages":[{"role":5,"content":"x"},{"role":"b","content":"y"}]}', False), ('{"messages":[{"content":"x"},{"role":"b","content":"y"}]}', False),
    ('{"messages":[{"role":"a","content":null},{"role":"b","content":"y"}]}', False), ('{"messages":[{"role":"a","content":3},{"role":"b","content":"y"}]}', False),
    ('{"messages":[{"role":"a","content":"  "},{"role":"b","content":"y"}]}', False), ('{"messages":[{"role":"a","content":"x","k":1},{"role":"b","content":"y"},{}],"z":2}', True), ("[]", False), ("3", False),
]


def test_validity_of_lines(spark):
    df = spark.createDataFrame(EXAMPLES, "value string, want boolean")
    assert df.where(examples.is_valid_json(F.col("value")) != F.col("want")).collect() == []
    typed = examples.read_examples(df.where("value not like '%:5,%' and value not like '%:3}%'"))
    assert typed.where(examples.is_valid(F.col("messages")) != F.col("want")).collect() == []


def test_strip_is_pythons(spark):
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    assert len(spaces) == 29
    rows = spark.createDataFrame([(c, f"{c}a{c}b{c}") for c in spaces], "c string, x string")
    for r in rows.select("x", t.py_strip(F.col("x")).alias("s"), t.has_text(F.col("c")).alias("h")).collect():
        assert r.s == r.x.strip() and not r.h


def test_fill():
    assert t.fill("{{x}} {n} {topic} {other}", n=3, topic="a{n}") == "{x} 3 a{n} {other}"
    for bad in ("{a.b}", "{}", "{0}", "{", "}"):
        with pytest.raises(ValueError):
            t.fill(bad, n=1)


def test_split_specifications():
    assert hub.split_of("train[:60000]") == ("train", 60000) and hub.split_of("test") == ("test", None)
    with pytest.raises(ValueError):
        hub.split_of("train[5:]")


def test_slices_in_storage_order(spark, tmp_path):
    shelf = hub.Registry(f"file://{tmp_path}")
    rows = spark.range(100).select((100 - F.col("id")).alias("text"), F.col("id").alias("place"))
    shelf.push(rows.repartitionByRange(7, "place").sortWithinPartitions("place"), "d")
    for n in (0, 1, 20, 99, 100, 300):
        assert sorted(r.place for r in shelf.pull(spark, "d", f"train[:{n}]").collect()) == list(range(min(n, 100)))
    keyed = shelf.pull(spark, "d", "train[:50]", key="_key")
    assert keyed.columns == ["text", "place", "_key"] and keyed.select("_key").distinct().count() == 50
    assert [r.text for r in shelf.pull(spark, "d", "train[:2]", order="text").collect()] == [1, 2]
    shelf.register("own", lambda s, split, config: rows)
    assert shelf.pull(spark, "own").count() == 100 and shelf.pull(spark, "own", "train[:3]", order="place").count() == 3
    with pytest.raises(ValueError):
        shelf.pull(spark, "own", "train[:3]")


VALUES = [
    "{}", '{"a":1}', "[1, 2]", " 1 ", '"x"', "null", "true", "1.0", "-0", "1e999", '{"a":1} x', '{"a":1},{"b":2}', "1 2", "", " ", "{", "{'a':1}", '{"a":1,"a":2}', "NaN", "-Infinity", '"a\tb"', '"\\u00e9"', '"\\x"', "01", "+1", "1.", ".5",
    '{"a":}', "[1,]", "[,]", "\ufeff{}", "// c", "/* c */ 1", "1" * 4301, "[" * 2000 + "]" * 2000, '{"a":{"b":[{"c":null}]}}', "]", "1]", "],[", None, "\u00a01", '"\ud83d\ude00"'.encode("utf-16", "surrogatepass").decode("utf-16"), "tru", "True",
]


def test_json_is_what_python_reads(spark):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i int, v string")
    for r in rows.select("i", "v", js.is_json("v").alias("got")).collect():
        assert r.got == js._parse(r.v)[0], (r.v or "")[:40]


def test_lines_are_numbered_where_they_lie(spark, tmp_path):
    for k in range(3):
        put(tmp_path / f"{k}.jsonl", "\n".join(f'{{"k":{k},"i":{i},"pad":"{"x" * (i % 50)}"}}' for i in range(1, 3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows, _ = jsonl.scan_folder(spark, f"file://{tmp_path}")
        bad = rows.where(F.get_json_object("value", "$.i").cast("long") != F.col("line_no")).count()
        assert bad == 0 and rows.count() == 3 * 2999
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_local_tokenizers(spark, tmp_path, capsys):
    import public_tokenizers

    for name in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"):
        path = public_tokenizers.path(name)
        assert len(tokenizers.load(path)(["Hello world"])[0]) >= 2
        cli.check_tokenizer(spark, path)
    said = capsys.readouterr().out
    assert said.count("Pure English") == 3 and said.count("Tokenizer:") == 3
    folder = tmp_path / "model"
    folder.mkdir()
    with pytest.raises(FileNotFoundError):
        cli.check_tokenizer(spark, str(folder))
    os.symlink(public_tokenizers.path("byte_bpe_50k.json"), folder / "tokenizer.json")
    assert tokenizers.load(str(folder))(["Hello world"]) == tokenizers.load(public_tokenizers.path("byte_bpe_50k.json"))(["Hello world"])
    with pytest.raises(ValueError):
        put(tmp_path / "x.bin", "x")
        tokenizers.load(str(tmp_path / "x.bin"))


def test_commands(spark, tmp_path):
    raw = tmp_path / "unprocessed"
    pair = lambda a, b: json.dumps({"messages": [{"role": "user", "content": a}, {"role": "assistant", "content": b}]})
    put(raw / "one.jsonl", "\n".join([pair("a", "b"), "{", pair("c", "d")[:-1] + ', "more": {"kept": [1]}}', pair("a", "B!")]))
    put(raw / "empty.jsonl", "")
    root = f"file://{tmp_path}"
    cfg = config.Config({"paths": {"unprocessed_data_dir": f"{root}/unprocessed", "refined_data_dir": f"{root}/refined", "removed_data_dir": f"{root}/removed", "local_dataset": f"{root}/refined/merged.jsonl", "hf_dataset": "chats"}, "sft_training": {"eval_split": "0.5"}})
    judge = lambda batches: batches.select("file", "batch_idx", F.lit('{"remove":[1],"reasons":{"1":"why"}}').alias("raw"))
    assert [p.rsplit("/", 1)[1] for p in cli.refine_command(spark, cfg, None, judge)] == ["one.jsonl"]
    assert cli.refine_command(spark, cfg, None, judge) == []  # the empty file stays pending, and brings nothing
    assert cli.refine_command(spark, cfg, "none.jsonl", judge) == []
    gone = [json.loads(r.value) for r in spark.read.text(f"{root}/removed/one.jsonl").collect()]
    assert gone == [{"example": {**json.loads(pair("c", "d")), "more": {"kept": [1]}}, "reason": "why", "global_idx": 1}]
    assert cli.merge_command(spark, cfg) and cli.merge_command(spark, cfg)
    assert [json.loads(r.value)["messages"][1]["content"] for r in spark.read.text(f"{root}/refined/merged.jsonl").collect()] == ["b", "B!"]
    shelf = hub.Registry(f"{root}/hub")
    cli.push_command(spark, cfg, shelf)
    cli.pull_command(spark, cfg, shelf)
    got = cli.finetuning_rows(spark, cfg, shelf, local=True)
    assert sorted(r.split for r in got.collect()) == ["eval", "train"]
    with pytest.raises(FileNotFoundError):
        hub.require(spark, f"{root}/none")
