"""Build the profile mart.

Options: ``spark.mart.index_nodes``, ``.wide_column_host``,
``.weblogs_path``, ``.categories_url``, ``.output_url``, ``.user``,
``.password`` and, where the names differ, ``.visits_index``, ``.keyspace``,
``.clients_table``, ``.categories_table``, ``.output_table``, ``.mode``,
``.output_partitions`` (connections of the write at a time; default 8).
"""

from clickloom.jobs.session import job_session
from clickloom.plans import REQUIRED, build_mart, job_conf
from clickloom.sinks import SinkSpec
from clickloom.sources import json_files, relational, search_index, wide_column


def main() -> None:
    spark = job_session("mart")
    conf = job_conf(
        spark,
        "spark.mart",
        {
            "index_nodes": (str, REQUIRED),
            "visits_index": (str, "visits"),
            "wide_column_host": (str, REQUIRED),
            "keyspace": (str, REQUIRED),
            "clients_table": (str, "clients"),
            "weblogs_path": (str, REQUIRED),
            "categories_url": (str, REQUIRED),
            "categories_table": (str, "domain_cats"),
            "output_url": (str, REQUIRED),
            "output_table": (str, "clients"),
            "user": (str, None),
            "password": (str, None),
            "mode": (str, "overwrite"),
            "output_partitions": (int, 8),
        },
    )
    login = {"user": conf["user"], "password": conf["password"]}
    build_mart(
        spark,
        clients=wide_column(conf["keyspace"], conf["clients_table"], conf["wide_column_host"]),
        visits=search_index(conf["visits_index"], conf["index_nodes"]),
        weblogs=json_files(conf["weblogs_path"]),
        categories=relational(conf["categories_url"], conf["categories_table"], **login),
        sink=SinkSpec.of(
            relational(conf["output_url"], conf["output_table"], **login),
            conf["output_partitions"],
        ),
        mode=conf["mode"],
    )


if __name__ == "__main__":
    main()
