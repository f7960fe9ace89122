"""Connector specs, exercised on a data source defined here.

No store is started: the double records the options it is opened with.
"""

import json

import pytest
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    WriterCommitMessage,
)

from clickloom.plans import REQUIRED, job_conf
from clickloom.sinks import SinkSpec, write_table
from clickloom.sources import (
    SourceSpec,
    json_files,
    read_table,
    relational,
    search_index,
    wide_column,
)
from clickloom.sources.paths import scratch_dir


class Reader(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def read(self, partition):
        yield json.dumps(dict(self.options), sort_keys=True), 1


class Writer(DataSourceWriter):
    def __init__(self, options, overwrite):
        self.options, self.overwrite = options, overwrite

    def write(self, iterator):
        found = [tuple(row) for row in iterator]
        with open(self.options["file"], "a") as out:
            out.write(json.dumps([self.overwrite, found]) + "\n")
        return WriterCommitMessage()


class Store(DataSource):
    @classmethod
    def name(cls):
        return "recording_store"

    def schema(self):
        return "options string, n int"

    def reader(self, schema):
        return Reader(self.options)

    def writer(self, schema, overwrite):
        return Writer(self.options, overwrite)


def test_read_passes_options_and_secrets(spark):
    spark.dataSource.register(Store)
    spec = SourceSpec("recording_store", {"host": "h"}, secrets={"password": "s3cret"})
    options = json.loads(read_table(spark, spec).first()["options"])
    assert options["host"] == "h" and options["password"] == "s3cret"
    assert "s3cret" not in repr(spec) and "s3cret" not in repr(SinkSpec.of(spec))


def test_write_passes_mode_and_bounds_connections(spark, tmp_path):
    spark.dataSource.register(Store)
    log = tmp_path / "log"
    spec = SinkSpec("recording_store", {"file": str(log)}, partitions=1)
    df = spark.createDataFrame([("a", 1), ("b", 2)], "options string, n int").repartition(2)
    for mode in ("overwrite", "append"):
        write_table(df, spec, mode)
    modes = [json.loads(line) for line in log.read_text().splitlines()]
    assert [m[0] for m in modes] == [True, False]
    assert all(sorted(m[1]) == [["a", 1], ["b", 2]] for m in modes)


def test_specs_of_the_four_stores():
    index = search_index("visits", "host:9200", **{"es.read.field.include": "uid"})
    assert (index.format, index.path) == ("org.elasticsearch.spark.sql", "visits")
    assert index.options == {"es.nodes": "host:9200", "es.read.field.include": "uid"}
    wide = wide_column("ks", "clients", "host")
    assert wide.format == "org.apache.spark.sql.cassandra"
    assert wide.options["spark.cassandra.connection.port"] == "9042"
    assert wide.options["keyspace"] == "ks" and wide.options["table"] == "clients"
    table = relational("jdbc:x", "t", user="u", password="p", partition=("id", 0, 100, 8))
    assert table.options["partitionColumn"] == "id" and table.options["numPartitions"] == "8"
    assert table.secrets == {"user": "u", "password": "p"} and "password" not in table.options
    assert relational("jdbc:x", "t").secrets == {}
    assert json_files("/p").schema.fieldNames() == ["uid", "visits"]


def test_job_conf_types_defaults_and_required(spark):
    spark.conf.set("spark.demo.n", "7")
    options = {"n": (int, 1), "name": (str, None), "must": (str, REQUIRED)}
    with pytest.raises(ValueError, match="spark.demo.must"):
        job_conf(spark, "spark.demo", options)
    spark.conf.set("spark.demo.must", "x")
    assert job_conf(spark, "spark.demo", options) == {"n": 7, "name": None, "must": "x"}


def test_scratch_is_in_the_shared_folder_and_fresh(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    one, two = scratch_dir(spark), scratch_dir(spark)
    assert one != two and one.startswith(base) and two.startswith(base)
