import datetime as dt
import os

import pytest
from pyspark.errors import StreamingQueryException

from regiocast.sources import schemas
from regiocast.sources.landing import land
from regiocast.streaming import land_available

D = dt.date


def _drop(spark, folder, rows):
    spark.createDataFrame(rows, "date string, region string, total string").coalesce(1).write.mode("append").option(
        "header", True
    ).csv(folder)


def _land(spark, src, dst, **kwargs):
    return land_available(spark, src, dst, schemas.SUMMARY_RAW, schemas.SUMMARY, **kwargs)


def test_stream_landing_is_incremental_and_accounts_for_every_row(spark, scratch):
    src, dst = f"{scratch}/drops", f"{scratch}/landed"
    _drop(spark, src, [("2021-01-01", "A", "3"), ("2021-01-02", "A", "4")])
    landed = _land(spark, src, dst, on_bad="quarantine")
    assert sorted(r.total for r in landed.rows.collect()) == [3, 4] and landed.rejected.count() == 0
    # a second drop, two bad rows in it: three rows in, three accounted for
    _drop(spark, src, [("2021-01-03", "B", "5"), ("2021-01-04", "B", "oops"), ("soon", "B", "6")])
    landed = _land(spark, src, dst, on_bad="quarantine")
    assert sorted((r.date, r.region, r.total) for r in landed.rows.collect()) == [
        (D(2021, 1, 1), "A", 3),
        (D(2021, 1, 2), "A", 4),
        (D(2021, 1, 3), "B", 5),
    ]
    assert sorted((r.total, r._reason) for r in landed.rejected.collect()) == [("6", "date"), ("oops", "total")]
    # nothing new: a rerun adds nothing
    again = _land(spark, src, dst, on_bad="quarantine")
    assert (again.rows.count(), again.rejected.count()) == (3, 2)


def _file(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(lines) + "\n")


def test_each_file_is_read_by_its_own_header_in_batch_and_stream(spark, scratch):
    src = f"{scratch}/drops"
    _file(src, "a.csv", "date,supplier,region,age,men,women", "2021-02-01,S,A,20-29,111,1")
    _file(src, "b.csv", "date,supplier,region,age,women,men", "2021-02-02,S,A,20-29,2,111")
    _file(src, "c.csv", "women,age,region,supplier,date", '3,20-29,"A, B",S,2021-02-03')
    _file(src, "d.csv", "giorno,fornitore,area,fascia,uomini,donne", "2021-02-04,S,A,20-29,111,4")
    _file(src, "e.csv", "date,supplier,region,age,men,women")
    want = [(D(2021, 2, i), "A, B" if i == 3 else "A", i) for i in (1, 2, 3, 4)]
    batch = land(spark, src, f"{scratch}/batch", schemas.DOSES_RAW, schemas.DOSES)
    assert sorted((r.date, r.region, r.women) for r in batch.collect()) == want
    stream = land_available(spark, src, f"{scratch}/stream", schemas.DOSES_RAW, schemas.DOSES, max_files_per_trigger=2)
    assert sorted((r.date, r.region, r.women) for r in stream.rows.collect()) == want
    assert len([f for f in os.listdir(f"{scratch}/stream") if f.startswith("batch=")]) == 3


@pytest.mark.parametrize("header", ["date,supplier,region,age,men,females", "date,date,region,age,men,women", "a,b,c"])
def test_an_unknown_header_stops_batch_and_stream(spark, scratch, header):
    src = f"{scratch}/drops"
    _file(src, "a.csv", "date,supplier,region,age,men,women", "2021-02-01,S,A,20-29,111,1")
    _file(src, "b.csv", header, ",".join("x" * len(header.split(","))))
    with pytest.raises(ValueError):
        land(spark, src, f"{scratch}/batch", schemas.DOSES_RAW, schemas.DOSES)
    with pytest.raises(StreamingQueryException):
        land_available(spark, src, f"{scratch}/stream", schemas.DOSES_RAW, schemas.DOSES)
    assert not os.path.exists(f"{scratch}/batch")


def test_a_batch_that_runs_again_replaces_its_rows(spark, scratch):
    """The commit of a batch is lost after its tables were written: nothing is there twice."""
    src, dst = f"{scratch}/drops", f"{scratch}/landed"
    _drop(spark, src, [("2021-01-01", "A", "3"), ("2021-01-04", "B", "oops")])
    _land(spark, src, dst, on_bad="quarantine", checkpoint=f"{scratch}/ckpt")
    os.remove(f"{scratch}/ckpt/commits/0")
    os.remove(f"{scratch}/ckpt/commits/.0.crc")
    again = _land(spark, src, dst, on_bad="quarantine", checkpoint=f"{scratch}/ckpt")
    assert (again.rows.count(), again.rejected.count()) == (1, 1)


def test_a_bad_row_stops_the_stream_by_default(spark, scratch):
    _drop(spark, f"{scratch}/drops", [("2021-01-01", "A", "3"), ("2021-01-04", "B", "oops")])
    with pytest.raises(StreamingQueryException):
        _land(spark, f"{scratch}/drops", f"{scratch}/landed")
