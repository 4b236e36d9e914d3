from __future__ import annotations

from corpuslens.streaming.journal import journal_stream, keep_latest


def test_latest_of_each_key_over_two_batches(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.json").write_text('{"k": "x", "i": 1}\n{"k": "y", "i": 2}\n{"k": ')
    run = lambda: keep_latest(journal_stream(spark, str(source), "k string, i int"), out, str(tmp_path / "cp"), ["k"], "i").awaitTermination()
    run()
    (source / "b.json").write_text('{"k": "x", "i": 3}\n')
    run()
    last = max(p.name for p in (tmp_path / "out").iterdir())
    assert {r.k: r.i for r in spark.read.parquet(f"{out}/{last}").collect()} == {"x": 3, "y": 2}
