from __future__ import annotations

import json
from pathlib import Path


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, value string")


def evaluate(spark, expression, *values):
    """The expression over column `value`, one result per input."""
    rows = texts(spark, *values).select("id", expression.alias("out")).orderBy("id").collect()
    return [row["out"] for row in rows]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def write_array(folder, name: str, records: list[dict], indent: int | None = 2) -> Path:
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(records, indent=indent, ensure_ascii=False), encoding="utf-8")
    return path


COMPLAINT = {
    "record_id": "complaint_1", "source": "nhtsa_complaints", "source_weight": 1.0,
    "make": "Ford Motor Company.", "model": "Escape", "year": 2015, "component": "AIR BAGS",
    "body": "bad brakes", "incident_date": "01/15/2020", "crash_involved": False,
    "fire_involved": True, "injuries": 0, "deaths": 0,
    "scraped_at": "2026-06-06T20:03:41.123456+00:00", "week_added": 1,
}
RECALL = {
    "record_id": "recall_1", "source": "nhtsa_recalls", "source_weight": 1.5,
    "make": "TESLA", "model": "", "year": 2016, "component": "AIR BAGS",
    "body": "good } brakes\n  },\n", "consequence": "not good", "remedy": "",
    "recall_date": "2020-01-15", "units_affected": 12,
    "scraped_at": "2026-06-06T20:03:41.123456+00:00", "week_added": 1,
}
