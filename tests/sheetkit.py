"""Sheets and reference tables for the tests."""

from __future__ import annotations

import csv
import io

from pyspark.sql import functions as F

from batchgate.plans import fish

HEADER = {
    "projectID": "37",
    "lakeID": "WL",
    "siteName": "DeepHole",
    "dateTimeSet": "2021-06-03 10:00:00",
    "dateTimeSample": "2021-06-03 11:26:00",
    "crew": "chris, stuart",
    "gear": "AN",
    "distanceShocked": "",
    "effort": "1.5",
    "effortUnits": "angler_hours",
    "comments": "",
    "useCPUE": "yes",
    "dataRecorder": "CTS",
    "dataEnteredBy": "SEJ",
    "metadataID": "Angling.20210601",
    "useSampleMarkRecap": "no",
    "sampleGroup": "angling",
}
COLUMNS = [
    "fishNum", "species", "fishLength", "fishWeight", "clipApply", "clipRecapture", "pitApply", "pitRecapture",
    "floyApply", "floyRecapture", "mortality", "removed", "otolithSample", "dietSampled", "scaleSample", "spineSample",
]
TRAP_COLUMNS = ["trapNumber", "fishNum", "species", "fishLength", "fishWeight", "clipApply", "clipRecapture", "mortality"]

NAME = "lake_2021-06-03_1126.csv"
TRAP_NAME = "WL_minnowtrap_2021-06-03.csv"


def fish_row(num=1, species="LMB", length=220, weight=None, **more):
    """A fish of the usual weight for its length."""
    weight = round(usual_weight(length), 1) if weight is None and length not in (None, "") else weight
    return {"fishNum": num, "species": species, "fishLength": length, "fishWeight": weight, **more}


def usual_weight(length):
    return 1e-5 * float(length) ** 3


def sheet(rows, header=None, columns=None, trap=False, drop=(), names=None, raw=()):
    """Text of a sheet: header overrides, rows as dicts, ``raw`` lines appended as they are."""
    h = {k: v for k, v in {**HEADER, **(header or {})}.items() if k not in drop and not (trap and k == "siteName")}
    columns = columns or (TRAP_COLUMNS if trap else COLUMNS)
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\r\n")
    for k, v in h.items():
        w.writerow([k, v])
    w.writerow(names or columns)
    for r in rows:
        w.writerow(["" if r.get(c) is None else r.get(c) for c in columns])
    return "﻿" + out.getvalue() + "".join(x + "\r\n" for x in raw)


def lines(spark, sheets):
    from batchgate.sources.sheets import lines_of

    return lines_of(spark.createDataFrame(list(sheets.items()), "entry_file string, content string"))


def history_records(spark, extra=()):
    """Forty largemouth and perch each with lengths around 200, ten rare fish, and tags."""
    rows = []
    for i in range(40):
        for otu in ("largemouth_bass", "yellow_perch"):
            length = 180.0 + i
            rows.append(
                {
                    "fishID": f"WL_DeepHole_20200601_1000_AN_Angling.20200601_{len(rows)}",
                    "sampleID": "WL_DeepHole_20200601_1000_AN_Angling.20200601",
                    "otu": otu,
                    "fishLength": length,
                    "fishWeight": usual_weight(length) * (1.05 if i % 2 else 0.95),
                }
            )
    for i in range(14):
        rows.append(
            {"fishID": f"EL_Dock_20200701_0900_FN_Fyke.20200701_{i}", "otu": "walleye", "fishLength": 300.0 + i, "fishWeight": 250.0}
        )
    rows[0].update(pitApply="P1", clipApply="LV")
    rows[1].update(pitApply="P2")
    rows[80].update(floyApply="F1", otu="walleye")
    rows += list(extra)
    full = [tuple(r.get(c) for c in fish.RECORD_SCHEMA.fieldNames()) for r in rows]
    return spark.createDataFrame(full, fish.RECORD_SCHEMA)


def reference(spark, extra_records=()):
    sample = {
        "projectID": 37.0,
        "lakeID": "WL",
        "siteID": "WL_DeepHole",
        "sampleID": "WL_DeepHole_20200601_1000_AN_Angling.20200601",
        "gear": "AN",
        "effortUnits": "angler_hours",
        "useCPUE": "yes",
        "useSampleMarkRecap": "no",
        "metadataID": "Angling.20210601",
        "sampleGroup": "angling",
    }
    trap = {**sample, "gear": "MT", "effortUnits": "trap_hours", "sampleID": "x", "metadataID": "Trap.20210601"}
    names = fish.SAMPLE_SCHEMA.fieldNames()
    otu = [
        ("largemouth_bass", "LMB", "fish"),
        ("yellow_perch", "YWP", "fish"),
        ("walleye", "WAE", "fish"),
        ("minnow_unidentifiable", "MNW", "fish"),
        ("daphnia", "DAP", "zoops"),
        ("zz_second_name", "LMB", "fish"),
    ]
    return {
        "lakes": spark.createDataFrame([("WL",), ("EL",)], "lakeID string"),
        "sites": spark.createDataFrame([("WL_DeepHole",), ("EL_Dock",), ("WL_MT.007",)], "siteID string"),
        "otu": spark.createDataFrame(otu, "otu string, abbreviation string, grouping string"),
        "samples": spark.createDataFrame([tuple(s.get(c) for c in names) for s in (sample, trap)], fish.SAMPLE_SCHEMA),
        "records": history_records(spark, extra_records),
    }


def rules_found(judged, entry_file=None):
    """Names of the error rules found, sorted."""
    errors = judged.filter("severity = 'error'")
    if entry_file:
        errors = errors.filter(F.col("entry_file") == entry_file)
    return sorted({r["rule"] for r in errors.select("rule").collect()})
