"""Each registered query of the library against its SQL, on the smallest tables."""

import os

import pytest

from quillmill.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: One query for each way of making rows; the driver holds all of them.
SOME = ["audit_rollup", "percentiles_by_lang", "caption_validate", "canonical_json", "level_unpivot", "kept_levels", "gate_decision", "group_split", "term_coverage_cube", "label_mask", "strided_shard", "running_best", "jsonl_bad_line", "document_folder", "topic_file", "label_errors", "encode_rows", "correct_and_judge", "prediction_records", "matched_targets", "decomposition_validate", "orphan_elements", "keyed_results", "keyed_todo", "stream_resume", "ordered_predictions", "finalised_labels", "null_paths", "stripped_leaves", "canonical_fingerprint", "best_partial", "prompt_files"]


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    return round(float(value), 9) if isinstance(value, (int, float)) else str(value)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", SOME)
def test_query_matches_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    cursor = con.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    want = sorted((tuple(plain(v) for _, v in sorted(zip(columns, row, strict=True))) for row in cursor.fetchall()), key=repr)
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    got = sorted((tuple(plain(r[c]) for c in sorted(columns)) for r in df.collect()), key=repr)
    assert got == want
