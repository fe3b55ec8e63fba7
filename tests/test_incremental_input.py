"""The event files of the incremental job."""

import pytest

from clipsift.plans.queries import composite


class Built(Exception):
    pass


def test_one_task_writes_lines_but_joins_nothing(spark, tmp_path, monkeypatch):
    tables = {
        "events": "SELECT id AS event_id, timestamp'2024-01-01' AS ts, id % 7 AS user_id, 'view' AS event_type, 1.0D AS value, '{}' AS props FROM range(50)",
        "documents": "SELECT id * 4 AS doc_id, 'a' AS text, 'en' AS lang, 'web' AS source, 1L AS n_chars FROM range(5)",
        "embeddings": "SELECT id AS vec_id, 1 AS label, array_repeat(0.5F, 64) AS embedding FROM range(3)",
        "labels": "SELECT id AS doc_id, 1 AS quality, 0 AS toxic FROM range(3)",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(str(tmp_path / f"{name}.parquet"))
    kept, places, real, path = [], {}, composite.durable, composite.scratch_path
    monkeypatch.setattr(composite, "durable", lambda df, name: kept.append((df, real(df, name))) or kept[-1][1])
    monkeypatch.setattr(composite, "scratch_path", lambda s, name: places.setdefault(name, path(s, name)))

    def stop(*args, **options):
        raise Built

    monkeypatch.setattr(composite.jobs, "incremental", stop)
    with pytest.raises(Built):
        composite.q_job_incremental(spark, str(tmp_path))
    (before, after), = kept
    assert "Join" in before._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in after._jdf.queryExecution().optimizedPlan().toString()
    files = [f for f in spark.read.text(places["events"]).select("_metadata.file_path").distinct().collect()]
    assert len(files) == 4 and spark.read.text(places["events"]).count() == 50
