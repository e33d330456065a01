"""The ten stages over a raw table: profile, clean, score, enrich, augment, format, validate, count tokens, split, report.

``python -m parley.plans.pipeline --raw_path raw.csv --base_dir out --quality_threshold 5.0``
"""

from __future__ import annotations

import argparse
import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators import augment, chat, clean, enrich, profile, report, score, split, tokens, validate
from parley.sources import io

log = logging.getLogger("parley")


def tables(raw: DataFrame, threshold: float = 5.0) -> dict[str, DataFrame]:
    """Lazy tables of the stages; ``raw`` has row_id, instruction, response, category, intent and perhaps flags."""
    cleaned = clean.clean(raw)
    filtered = score.passing(cleaned, threshold)
    enriched = enrich.enrich(filtered)
    return {"raw": raw, "cleaned": cleaned, "filtered": filtered, "enriched": enriched, "augmented": augment.augment(enriched)}


def run(spark: SparkSession, raw: DataFrame, base_dir: str, threshold: float = 5.0, fail_on_invalid: bool = False, reports_dir: str | None = None) -> dict:
    """Write all tables and reports under ``base_dir``; return the consolidated report.

    The cleaned and the augmented table are written and reread, and the cleaning is counted as it is written, so no stage is
    computed twice.
    """
    keep = lambda df, name: (df.write.mode("overwrite").parquet(f"{base_dir}/data/{name}"), spark.read.parquet(f"{base_dir}/data/{name}"))[1]
    io.snapshot(raw, f"{base_dir}/data/raw")
    rows, counters = clean.clean_counted(raw)
    cleaned = keep(rows, "cleaned")
    filtered = score.passing(cleaned, threshold)
    augmented = keep(augment.augment(enrich.enrich(filtered)), "augmented")
    enriched = augmented.where("variant_no = 0")
    formatted = chat.formatted(augmented)
    for name in ("alpaca", "chatml"):
        formatted.select(name).write.mode("overwrite").json(f"{base_dir}/data/final/{name}")
    chats = formatted.select("row_id", "variant_no", "messages", "metadata")
    parts = split.split(chats, keys=("row_id", "variant_no"))
    parts.select("messages", "metadata", "split").write.mode("overwrite").partitionBy("split").option("ignoreNullFields", False).json(f"{base_dir}/data/final/splits")
    counts = lambda df, *by: {"/".join(map(str, r[:-1])): r[-1] for r in df.groupBy(*by).count().collect()}
    rows_valid, formats_valid = report.as_dict(validate.validate_rows(augmented)), report.as_dict(validate.validate_formats(formatted))
    out = report.consolidated({
        "eda": report.as_dict(profile.profile(raw)) | report.as_dict(profile.length_stats(raw)) | report.as_dict(profile.distinct_counts(raw)),
        "cleaning": counters.get,
        "quality": report.as_dict(score.report(cleaned, threshold)),
        "enrichment": {c: counts(enriched, c) for c in enrich.LABELS},
        "augmentation": counts(augmented, "augmentation_type"),
        "validation": rows_valid | {"formats": formats_valid, "overall_valid": rows_valid["is_valid"] and formats_valid["is_valid"]},
        "tokens": report.as_dict(tokens.token_stats(chats)),
        "split": counts(parts, "split"),
        "intents": counts(parts.select("split", F.coalesce("metadata.intent", F.lit("unknown")).alias("intent")), "split", "intent"),
        "progression": [r.asDict() for r in report.progression({"raw": raw, "cleaned": cleaned, "filtered": filtered, "augmented": augmented}).orderBy("stage_no").collect()],
    })
    if reports_dir:
        report.write_json(out, f"{reports_dir}/consolidated.json")
        for stage, content in out.items():
            if not isinstance(content, dict | list):
                continue
            report.write_text(report.markdown(stage, content if isinstance(content, dict) else {str(i): c for i, c in enumerate(content)}), f"{reports_dir}/{stage}.md")
        report.write_metrics_csv(dict(report.metrics(out)), f"{reports_dir}/metrics.csv")
    if not out["validation"]["overall_valid"]:
        log.warning("the data set is not valid")
        if fail_on_invalid:
            raise ValueError("the data set is not valid")
    return out


def log_to(path: str | None) -> None:
    """Log to the console, and to a file if one is named."""
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if path:
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        handlers.append(logging.FileHandler(path, encoding="utf-8"))
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s", handlers=handlers, force=True)


def main() -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--raw_path", required=True)
    p.add_argument("--base_dir", required=True)
    p.add_argument("--reports_dir", default=None)
    p.add_argument("--quality_threshold", type=float, default=5.0)
    p.add_argument("--fail_on_invalid", action="store_true")
    a = p.parse_args()
    log_to(f"{a.reports_dir or a.base_dir + '/reports'}/pipeline.log")
    spark = SparkSession.builder.getOrCreate()
    raw = io.with_row_id(io.read_csv(spark, a.raw_path))
    run(spark, raw, a.base_dir, a.quality_threshold, a.fail_on_invalid, a.reports_dir or f"{a.base_dir}/reports")


if __name__ == "__main__":
    main()
