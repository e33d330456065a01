"""Reports: stage progression, flat metrics, JSON, Markdown and PDF-free text files on the driver."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def progression(counts: dict[str, DataFrame]) -> DataFrame:
    """stage_no, stage, n_rows, delta to the stage before, of named tables."""
    out = None
    for i, (stage, df) in enumerate(counts.items()):
        row = df.agg(F.count("*").alias("n_rows")).select(F.lit(i).alias("stage_no"), F.lit(stage).alias("stage"), "n_rows")
        out = row if out is None else out.union(row)
    before = out.select((F.col("stage_no") + 1).alias("stage_no"), F.col("n_rows").alias("_before"))
    return out.join(F.broadcast(before), "stage_no", "left").select("stage_no", "stage", "n_rows", (F.col("n_rows") - F.coalesce("_before", "n_rows")).alias("delta"))


def headline(raw: DataFrame, threshold: float = 5.0) -> DataFrame:
    """One row, in one pass over the raw table: the counters at the head of the consolidated report, and the mean score of
    the cleaned rows. Every passed row has four variants, and the splits' sizes follow from their number."""
    from parley.operators import clean, score

    rows = score.with_scores(clean.grouped(raw).select("reason", "n", "row.*"))
    kept, passed = F.col("reason") == "kept", F.col("quality_score") >= threshold
    out = rows.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_records"), F.count_if(kept).alias("cleaned_records"), F.count_if(kept & passed).alias("quality_passed_records"),
        F.round(F.avg(F.when(kept, F.col("quality_score"))), 6).alias("average_quality_score"),
    )
    n = F.col("quality_passed_records") * 4
    train, val = F.floor(n * F.lit(0.8)).cast("long"), F.floor(n * F.lit(0.1)).cast("long")
    return out.select(
        "raw_records", "cleaned_records", "quality_passed_records", n.alias("augmented_records"), (F.col("raw_records") - F.col("cleaned_records")).alias("removed_cleaning_count"),
        (F.col("cleaned_records") - F.col("quality_passed_records")).alias("removed_quality_count"), (n - F.col("quality_passed_records")).alias("augmented_added_count"),
        train.alias("train_records"), val.alias("val_records"), (n - train - val).alias("test_records"), "average_quality_score",
    )


def stages(raw: DataFrame, threshold: float = 5.0) -> DataFrame:
    """stage_no, stage, n_rows, delta of the raw, cleaned, filtered and augmented rows, in one pass over the raw table."""
    names = (("raw", "raw_records"), ("cleaned", "cleaned_records"), ("filtered", "quality_passed_records"), ("augmented", "augmented_records"))
    rows = [F.struct(F.lit(i).alias("stage_no"), F.lit(n).alias("stage"), F.col(c).alias("n_rows"), (F.col(c) - F.col(names[max(0, i - 1)][1])).alias("delta")) for i, (n, c) in enumerate(names)]
    return headline(raw, threshold).select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def metrics(report: dict) -> list[tuple[str, object]]:
    """The rows of the flat metrics table, from a consolidated report."""
    quality, tokens = report.get("quality", {}), report.get("tokens", {})
    return [
        *[(k, report.get(k, 0)) for k in ("raw_records", "cleaned_records", "quality_passed_records", "augmented_records", "train_records", "val_records", "test_records")],
        ("removed_in_cleaning", report.get("removed_cleaning_count", 0)), ("removed_in_quality_filtering", report.get("removed_quality_count", 0)),
        ("augmented_variations_added", report.get("augmented_added_count", 0)), ("average_quality_score", quality.get("mean_quality")),
        ("average_tokens_per_sample", tokens.get("avg_full_tokens")), ("max_tokens_sample", tokens.get("max_full_tokens")),
        ("recommended_max_sequence_length", tokens.get("recommended_length")), ("pipeline_validation_passed", report.get("validation", {}).get("overall_valid")),
    ]


def consolidated(parts: dict) -> dict:
    """The ten headline counters and the stages' sections, of what the stages reported; missing parts count 0."""
    cleaning, quality, augmentation, split = (parts.get(k, {}) for k in ("cleaning", "quality", "augmentation", "split"))
    total = sum(augmentation.values())
    return {
        "raw_records": parts.get("eda", {}).get("n_rows", 0), "cleaned_records": cleaning.get("final_rows", 0), "quality_passed_records": quality.get("passed", 0), "augmented_records": total,
        "removed_cleaning_count": cleaning.get("total_removed", 0), "removed_quality_count": quality.get("filtered", 0), "augmented_added_count": total - augmentation.get("original", 0),
        "train_records": split.get("train", 0), "val_records": split.get("validation", 0), "test_records": split.get("test", 0),
    } | parts


def flat(row: DataFrame) -> DataFrame:
    """A one-row report as (metric, value) rows."""
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in row.columns])).alias("x")).select("x.*")


def as_dict(row: DataFrame) -> dict:
    """A one-row report on the driver."""
    return row.first().asDict(recursive=True)


def write_json(report: dict, path: str) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(report, f, indent=4, ensure_ascii=False, default=str)


def markdown(title: str, report: dict) -> str:
    lines = [f"# {title}", "", "| Metric | Value |", "|---|---|"]

    def add(prefix: str, value) -> None:
        if isinstance(value, dict):
            for k, v in value.items():
                add(f"{prefix}.{k}" if prefix else str(k), v)
        else:
            lines.append(f"| {prefix} | {value} |")

    add("", report)
    return "\n".join(lines) + "\n"


def write_text(text: str, path: str) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def write_metrics_csv(report: dict, path: str) -> None:
    rows = ["Metric Key,Metric Value", *(f"{k},{v}" for k, v in report.items())]
    write_text("\n".join(rows) + "\n", path)
