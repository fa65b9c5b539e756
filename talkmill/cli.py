"""Commands: generate, refine, merge, push, pull, check-tokenizer, prepare-cpt, prepare-sft, prepare (both)."""

from __future__ import annotations

import argparse
import os
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from talkmill.functions.text import run_name
from talkmill.functions.tokenizers import load
from talkmill.operators import dedup, examples, generate, mix, refine, render, transport
from talkmill.session import session
from talkmill.sources import config, files, jsonl
from talkmill.sources.hub import Registry, require


#: Lines of a log that a command prints; it says how many more there are.
LOG = 200


def generate_command(spark: SparkSession, cfg: config.Config, name: str | None, send: transport.Transport | None = None) -> str:
    """Topics are asked about in waves, as many at once as there are workers, and each wave is written when it is done. A run that
    ends early leaves what its waves have brought; the same name again goes on from there."""
    api, paths = cfg["generation"], cfg["paths"]
    api.configured()
    base = run_name(name, datetime.now())
    out = f"{files.made(spark, paths.unprocessed_data_dir)}/{base}"
    waves = f"{paths.unprocessed_data_dir}/.waves/{base}"
    send = send or transport.HttpTransport(api.endpoint, transport.require_key(api))
    topics, step = config.topic_rows(spark, cfg.topics), api.workers()
    parts = [f"{waves}/{i}" for i in range(0, len(cfg.topics), step)]
    finished = lambda: [p for p in parts if files.exists(spark, f"{p}/_SUCCESS")]
    try:
        for i, path in zip(range(0, len(cfg.topics), step), parts):
            if not files.exists(spark, f"{path}/_SUCCESS"):
                wave = topics.where(F.col("topic_idx").between(i + 1, i + step))
                generate.generate(wave, api, send).write.mode("overwrite").parquet(path)
    finally:
        if have := finished():
            rows = spark.read.parquet(*have)
            for r in rows.where("error is not null").select("topic", "error").limit(LOG).collect():
                print(f"{r.topic}: {r.error}")
            lines = rows.where("messages is not null").select("topic_idx", "seq", F.to_json(F.struct("messages")).alias("line"))
            jsonl.write_jsonl(lines, out, ["topic_idx", "seq"], "line")
    files.removed(spark, waves)
    return out


def print_log(lines, order: list[str], column: str) -> None:
    """The first lines of a log, and how many more there are."""
    first = lines.orderBy(*order).limit(LOG + 1).collect()
    for r in first[:LOG]:
        print(r[column])
    if len(first) > LOG:
        print(f"... of {lines.count()} lines")


def refine_command(spark: SparkSession, cfg: config.Config, name: str | None, judge=None) -> list[str]:
    """Refines one file, or all that have no result yet. A file's rows are judged once: verdicts are written before both
    outputs are made from them."""
    api, paths = cfg["refinement"], cfg["paths"]
    if judge is None:
        api.configured()
        judge = refine.model_judge(api, transport.HttpTransport(api.endpoint, transport.require_key(api)))
    if name is not None:
        todo = [f"{paths.unprocessed_data_dir}/{name}"]
        if not files.exists(spark, todo[0]):
            print(f"{todo[0]} is missing")
            return []
    else:
        if not files.exists(spark, paths.unprocessed_data_dir):
            print(f"{paths.unprocessed_data_dir} is missing")
            return []
        every = files.listed(spark, paths.unprocessed_data_dir)
        todo = [p for p in every if not files.exists(spark, f"{paths.refined_data_dir}/{p.rsplit('/', 1)[-1]}")]
        print(f"{len(every) - len(todo)} files are done, {len(todo)} are pending")
    done = []
    for path in todo:
        rows, malformed = jsonl.scan_jsonl(spark, [path])
        print_log(malformed.select("line_no", F.concat(F.lit(f"{path}: line "), F.col("line_no").cast("string"), F.lit(" is malformed")).alias("line")), ["line_no"], "line")
        rows = examples.read_examples(jsonl.with_seq(rows)).select("file", "seq", "value", "messages")
        if rows.isEmpty():
            continue  # stays pending
        base = path.rsplit("/", 1)[-1]
        aside = f"{paths.removed_data_dir}/judged/{base}"
        refine.refine(rows, judge, api.batch_size).write.mode("overwrite").parquet(aside)
        judged = spark.read.parquet(aside)
        # removed rows first: a file counts as done once its refined rows are there
        jsonl.write_jsonl(refine.removed_lines(judged), f"{files.made(spark, paths.removed_data_dir)}/{base}", ["batch_idx", "i"], "line")
        jsonl.write_jsonl(refine.kept(judged), f"{files.made(spark, paths.refined_data_dir)}/{base}", ["batch_idx", "i"], "value")
        print_log(refine.removed_report(judged), ["global_idx"], "line")
        for r in refine.retention(judged).collect():
            print(f"{r.file}: kept {r.kept} of {r.total} ({r.percent}%)")
        done.append(path)
    return done


def merge_command(spark: SparkSession, cfg: config.Config) -> str | None:
    paths = cfg["paths"]
    found = jsonl.scan_folder(spark, paths.refined_data_dir, paths.local_dataset)
    if found is None:
        print("nothing to merge")
        return None
    first = dedup.merged(found[0].select("file", "line_no", "value"))
    jsonl.write_jsonl(first, paths.local_dataset, ["file", "line_no"], "value")
    for r in dedup.added_by_file(found[0], first).orderBy("file").collect():
        print(f"{r.file}: {r.added} new")
    return paths.local_dataset


def push_command(spark: SparkSession, cfg: config.Config, hub: Registry) -> str | None:
    from talkmill.schemas import EXAMPLE

    paths = cfg["paths"]
    if not files.exists(spark, paths.local_dataset):
        print(f"{paths.local_dataset} is missing")
        return None
    return hub.push(spark.read.schema(EXAMPLE).json(paths.local_dataset), paths.hf_dataset)


def pull_command(spark: SparkSession, cfg: config.Config, hub: Registry) -> str:
    paths = cfg["paths"]
    rows = hub.pull(spark, paths.hf_dataset)
    files.made(spark, paths.refined_data_dir)
    jsonl.write_jsonl(rows, paths.local_dataset)
    return paths.local_dataset


def pretraining_rows(spark: SparkSession, cfg: config.Config, hub: Registry, order: str = "reference", seed: int = 42):
    """The mixed corpus: one column, text."""
    cpt = cfg["cpt_training"]
    parts, weights = [], {}
    for k, d in enumerate(cpt.datasets):
        rows = hub.pull(spark, d.path, d.split, d.config, key="_key")
        keyed = rows.select(F.lit(f"{k}").alias("source_id"), F.xxhash64("_key").alias("row_key"), F.col(d.column).alias("text"))
        parts.append(keyed)
        weights[f"{k}"] = d.probability
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return mix.mixed(every, weights, cpt.max_examples, order, seed).select("text")


def finetuning_rows(spark: SparkSession, cfg: config.Config, hub: Registry, local: bool, template: str = "chatml", seed: int = 42):
    """(messages, text, split)."""
    paths, sft = cfg["paths"], cfg["sft_training"]
    if local:
        rows, _ = jsonl.scan_jsonl(spark, [require(spark, paths.local_dataset)], "fail")
        rows = examples.read_examples(rows).select("messages")
    else:
        rows = hub.pull(spark, paths.hf_dataset).select("messages")
    out = rows.withColumn("text", render.rendered(F.col("messages"), template)).withColumn("_key", F.md5("text"))
    return mix.exact_split(out, "_key", sft.eval_split, seed).drop("_key")


def check_tokenizer(spark: SparkSession, path: str) -> None:
    """How the tokenizer in a local file or folder does on the test strings."""
    load(path)  # a path that is none fails here, with its name
    rows = spark.createDataFrame(render.TEST_STRINGS, "label string, text string")
    print(f"Tokenizer: {path}")
    for r in render.report(rows, "label", "text", render.token_counter(lambda texts: [len(x) for x in load(path)(texts)])(F.col("text"))).collect():
        print(f"{r.label:<25} {r.chars:>6} {r.tokens:>7} {r.ratio:>7.2f} {r.assessment}")


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("command", choices=["generate", "refine", "merge", "push", "pull", "check-tokenizer", "prepare-cpt", "prepare-sft", "prepare"])
    parser.add_argument("name", nargs="?", help="a file, for generate and refine; a tokenizer's file or folder, for check-tokenizer")
    parser.add_argument("-c", "--config", default=None, help="a YAML file")
    parser.add_argument("-l", "--local", action="store_true", help="finetune on the merged file rather than the pulled set")
    parser.add_argument("--hub", default="data/hub", help="where named datasets lie")
    parser.add_argument("--out", default="data/train", help="where prepared sets go")
    given = parser.parse_args(args)
    cfg, hub, spark = config.load(given.config), Registry(given.hub), session()
    if given.command == "generate":
        print(generate_command(spark, cfg, given.name))
    elif given.command == "refine":
        refine_command(spark, cfg, given.name)
    elif given.command == "merge":
        merge_command(spark, cfg)
    elif given.command == "push":
        push_command(spark, cfg, hub)
    elif given.command == "pull":
        print(pull_command(spark, cfg, hub))
    elif given.command == "check-tokenizer":
        name = given.name or cfg["model"].name
        if not name:
            raise ValueError("check-tokenizer needs a tokenizer, or a configured model")
        check_tokenizer(spark, name if os.path.exists(name) else f"{given.hub}/{name}")
    if given.command in ("prepare-cpt", "prepare"):
        pretraining_rows(spark, cfg, hub).write.mode("overwrite").parquet(f"{given.out}/cpt")
    if given.command in ("prepare-sft", "prepare"):
        finetuning_rows(spark, cfg, hub, given.local).write.mode("overwrite").partitionBy("split").parquet(f"{given.out}/sft")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
