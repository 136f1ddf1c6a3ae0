"""Run statuses, and the file lister."""

import os

from tidemark.operators.runlog import run_status
from tidemark.sources.listing import list_files
from tidemark.operators.manifest import parse_listing


def test_run_status_order(spark):
    rows = [(True, 200, 5, None, None), (True, 204, 0, None, None), (True, 404, 0, None, None),
            (True, 200, 5, "boom", None), (True, 200, 5, None, "missing PK"), (True, 200, 0, None, None),
            (False, 200, 5, None, None)]
    df = spark.createDataFrame(rows, "found boolean, http int, n long, err string, verr string")
    got = [r[0] for r in df.select(run_status("n", "err", "verr", "http", "found")).collect()]
    assert got == ["SUCCESS", "NO_CONTENT", "API_ERROR", "FAILED", "VALIDATION_FAILED", "EMPTY", "TABLE_NOT_FOUND"]


def test_list_files_reads_no_content(spark, tmp_dir):
    for folder, name in [("2024", "12-a-202403.pdf"), ("2024", "notes.txt"), ("misc", "13-b-202403.PDF")]:
        os.makedirs(os.path.join(tmp_dir, folder), exist_ok=True)
        with open(os.path.join(tmp_dir, folder, name), "wb") as f:
            f.write(b"%PDF" * 10)
    listing = list_files(spark, tmp_dir)
    assert "content" not in listing.columns
    assert listing._jdf.queryExecution().executedPlan().toString().count("content") == 0
    parsed = parse_listing(listing)             # year folder + name pattern
    assert [(r["fincode"], r["report_type"], r["year_end"]) for r in parsed.collect()] == [(12, "A", 202403)]
