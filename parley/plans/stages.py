"""Each stage on its own, from table to table (CSV, JSON, JSON lines or Parquet, by suffix), with its reports.

``python -m parley.plans.stages clean --input raw.csv --output cleaned.csv --reports_dir reports``; the stages are eda, clean,
score, enrich, augment, format, validate, tokenize, split and reports, which merges what the others reported.
"""

from __future__ import annotations

import argparse
import glob
import json
import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators import augment, chat, clean, enrich, profile, report, score, split, tokens, validate
from parley.plans.pipeline import log_to
from parley.sources import io

log = logging.getLogger("parley")


def _counts(df: DataFrame, column: str) -> dict:
    return {str(r[0]): r[1] for r in df.groupBy(column).count().collect()}


def eda(spark, df, a) -> dict:
    if a.output:
        io.snapshot(df, a.output)
    rows = df.drop("row_id")
    out = report.as_dict(profile.profile(rows)) | report.as_dict(profile.length_stats(rows)) | report.as_dict(profile.distinct_counts(rows))
    out["categories"], out["top_intents"] = ({str(r[0]): r[1] for r in d.collect()} for d in (profile.value_counts(rows, "category"), profile.top_values(rows, "intent")))
    return {"eda": out}


def clean_stage(spark, df, a) -> dict:
    rows, counters = clean.clean_counted(df)
    io.write_table(rows, a.output)
    return {"cleaning": counters.get}


def score_stage(spark, df, a) -> dict:
    io.write_table(score.passing(df, a.threshold), a.output)
    return {"quality": report.as_dict(score.report(df, a.threshold))}


def enrich_stage(spark, df, a) -> dict:
    rows = enrich.enrich(df)
    io.write_table(rows, a.output)
    return {"enrichment": {c: _counts(rows, c) for c in enrich.LABELS}}


def augment_stage(spark, df, a) -> dict:
    rows = augment.augment(df, fraction=a.fraction)
    io.write_table(rows, a.output)
    return {"augmentation": _counts(rows, "augmentation_type")}


def format_stage(spark, df, a) -> dict:
    """``output`` is a folder: alpaca.json, chatml.json and messages.json are JSON arrays, chats.jsonl has messages and metadata."""
    rows = chat.formatted(df, a.system_prompt)
    sizes = {name: io.write_json(rows.select(f"{name}.*") if name == "alpaca" else rows.select(name), f"{a.output}/{name}.json") for name in ("alpaca", "chatml", "messages")}
    io.write_jsonl(rows.select("messages", "metadata"), f"{a.output}/chats.jsonl")
    return {"formatting": {f"{k}_records": n for k, n in sizes.items()} | {"chat_records": rows.count()}}


def validate_stage(spark, df, a) -> dict:
    rows = validate.validate_rows(df)
    formats = {kind: validate.validate_json(spark.read.text(path), kind) for kind in validate.JSON_RULES if (path := getattr(a, kind))}
    out = report.as_dict(rows) | {"formats": {k: report.as_dict(d) for k, d in formats.items()}}
    out["overall_valid"] = out["is_valid"] and all(f["is_valid"] for f in out["formats"].values())
    return {"validation": out}


def tokenize_stage(spark, df, a) -> dict:
    rows = chat.formatted(df, a.system_prompt)
    return {"tokens": report.as_dict(tokens.token_stats(rows, tokens.tokenizer_count(a.tokenizer) if a.tokenizer else tokens.estimate))}


def split_stage(spark, df, a) -> dict:
    """``output`` is a folder with one JSON lines table per split."""
    keys = tuple(c for c in ("row_id", "variant_no") if c in df.columns)
    chats = chat.formatted(df, a.system_prompt).select(*keys, "messages", "metadata")
    parts = split.split(chats, keys=keys)
    parts.select("messages", "metadata", "split").write.mode("overwrite").partitionBy("split").option("ignoreNullFields", False).json(a.output)
    return {"split": _counts(parts, "split"), "intents": _counts(parts.select(F.concat_ws("/", "split", F.coalesce("metadata.intent", F.lit("unknown"))).alias("intent")), "intent")}


def reports_stage(spark, df, a) -> dict:
    parts: dict = {}
    for path in sorted(glob.glob(f"{a.reports_dir}/stage_*.json")):
        with open(path, encoding="utf-8") as f:
            parts |= json.load(f)
    out = report.consolidated(parts)
    report.write_json(out, f"{a.reports_dir}/consolidated.json")
    report.write_metrics_csv(dict(report.metrics(out)), f"{a.reports_dir}/metrics.csv")
    return {}


STAGES = {
    "eda": eda, "clean": clean_stage, "score": score_stage, "enrich": enrich_stage, "augment": augment_stage, "format": format_stage, "validate": validate_stage,
    "tokenize": tokenize_stage, "split": split_stage, "reports": reports_stage,
}


def run(spark: SparkSession, a: argparse.Namespace) -> dict:
    """The stage's report, written as stage_<name>.json and one Markdown file per section."""
    df = io.read_table(spark, a.input) if a.input else None
    out = STAGES[a.stage](spark, df, a)
    for section, content in out.items():
        report.write_text(report.markdown(section, content), f"{a.reports_dir}/{section}.md")
    if out:
        report.write_json(out, f"{a.reports_dir}/stage_{a.stage}.json")
    log.info("%s: %s", a.stage, out)
    return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("stage", choices=STAGES)
    p.add_argument("--input")
    p.add_argument("--output")
    p.add_argument("--reports_dir", default="reports")
    p.add_argument("--threshold", type=float, default=5.0)
    p.add_argument("--fraction", type=float, default=1.0)
    p.add_argument("--system_prompt", default=chat.SYSTEM_PROMPT)
    p.add_argument("--tokenizer", help="a tokenizer file; else tokens are estimated")
    for kind in validate.JSON_RULES:
        p.add_argument(f"--{kind}", help=f"JSON lines in the {kind} format, to be validated")
    return p


def main() -> None:
    a = parser().parse_args()
    log_to(os.path.join(a.reports_dir, f"{a.stage}.log"))
    run(SparkSession.builder.getOrCreate(), a)


if __name__ == "__main__":
    main()
