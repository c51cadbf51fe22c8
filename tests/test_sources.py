"""Files on disk: gzip with a byte order mark, zip, TSV, globs, quoting, reuse."""

import datetime
import gzip
import zipfile

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from millrace.operators.ensembling import average_runs
from millrace.sources import readers as R, sinks as K


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns[:1])).collect()]


def test_gzip_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "a.csv.gz"
    with gzip.open(path, "wb") as out:
        out.write("﻿id,name,x\n007,a,1.5\n008,,\n".encode("utf-8"))
    df = R.read_csv(spark, str(path), "id string, name string, x double", ["id", "x"], unsplittable=True)
    assert rows(df) == [("007", 1.5), ("008", None)]
    inferred = R.read_csv(spark, str(path))
    assert dict(inferred.dtypes)["x"] == "double"


def test_typed(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("n,d,c\n1,2015-07-31,a\n2,2015-08-01,0\n")
    df = R.read_typed_csv(spark, str(path), ["n", "d", "c"], "nDc")
    assert rows(df) == [(1.0, datetime.date(2015, 7, 31), "a"), (2.0, datetime.date(2015, 8, 1), "0")]
    path.write_text("n,d,c\nx,2015-07-31,a\n")
    with pytest.raises((PySparkException, Py4JError)):
        R.read_typed_csv(spark, str(path), ["n", "d", "c"], "nDc").collect()
    with pytest.raises(ValueError):
        R.positional_schema(["a"], "nn")


def test_zip_with_quoted_line_breaks(spark, tmp_path):
    for i in range(2):
        with zipfile.ZipFile(tmp_path / f"part{i}.csv.zip", "w") as archive:
            archive.writestr("inner.csv", f'id,text\n{2 * i},"a\nb"\n{2 * i + 1},\n')
    df = R.read_zip_csv(spark, str(tmp_path / "*.zip"), T.StructType.fromDDL("id bigint, text string"))
    assert rows(df) == [(0, "a\nb"), (1, None), (2, "a\nb"), (3, None)]


def test_tsv_stage(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "id bigint, s string")
    K.write_stage(df, str(tmp_path / "s"), "tsv")
    assert rows(R.read_tsv(spark, str(tmp_path / "s"), "id bigint, s string")) == [(1, "a,b"), (2, None)]
    with pytest.raises(ValueError):
        K.write_stage(df, str(tmp_path / "s"), "hdf")


def test_provenance_and_average_of_files(spark, tmp_path):
    for name, lines in {"m1": "1,0.2\n2,0.6\n", "m2": "1,0.4\n"}.items():
        (tmp_path / f"{name}.csv").write_text("id,p\n" + lines)
    df = R.read_with_provenance(spark, str(tmp_path / "m*.csv"), "id bigint, p double")
    assert {r["file"].rsplit("/", 1)[1] for r in df.collect()} == {"m1.csv", "m2.csv"}
    assert {r["id"]: r["p"] for r in average_runs(df, "id", "p", "file", "files").collect()} == {
        1: pytest.approx(0.3), 2: 0.3}


@pytest.mark.parametrize("quoting,header,line", [
    ("nonnumeric", '"id","name","p"', '1,"a""b",0.500000000'),
    ("none", "id,name,p", '1,a"b,0.500000000')])
def test_quoting(spark, tmp_path, quoting, header, line):
    df = spark.createDataFrame([(1, 'a"b', 0.5)], "id bigint, name string, p double")
    K.write_csv(df, str(tmp_path / "o"), float_format="%.9f", quoting=quoting, order_by=["id"])
    [part] = list((tmp_path / "o").glob("part-*.csv.gz"))
    got = gzip.open(part, "rt").read().splitlines()
    if quoting == "nonnumeric":
        # the float column is text once formatted, and stays unquoted
        assert got == ['"id","name","p"', '1,"a""b",0.500000000']
    else:
        assert got == [header, line]


def test_materialize_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    folder = str(tmp_path / "m")
    assert K.materialize(spark, folder, build).count() == 5
    assert K.materialize(spark, folder, build).agg(F.sum("id")).first()[0] == 10
    assert len(calls) == 1
