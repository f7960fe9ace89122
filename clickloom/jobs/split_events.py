"""Split a topic by event kind and UTC date.

Options: ``spark.filter.topic_name``, ``.offset``, ``.output_dir_prefix``,
``.bootstrap_servers``, ``.partitions`` (of the topic), ``.min_partitions`` (of
the read: lets several tasks share one large topic partition), ``.rebalance``
(1 merges small files by a shuffle, 0 writes as read; default 1), ``.layout``
(``moved``: ``<kind>/``, or ``versions``: published by a manifest, without moves).  With
``.topic_path`` (and ``.topic_format``) files stand in for a broker.
"""

from clickloom.jobs.session import job_session
from clickloom.plans import REQUIRED, job_conf, split_events
from clickloom.sources import TopicSpec


def main() -> None:
    spark = job_session("split-events")
    conf = job_conf(
        spark,
        "spark.filter",
        {
            "topic_name": (str, REQUIRED),
            "offset": (str, "earliest"),
            "output_dir_prefix": (str, REQUIRED),
            "bootstrap_servers": (str, "localhost:9092"),
            "partitions": (int, 1),
            "min_partitions": (str, None),
            "rebalance": (int, 1),
            "layout": (str, "moved"),
            "topic_path": (str, None),
            "topic_format": (str, "text"),
        },
    )
    if conf["topic_path"]:
        topic = TopicSpec(conf["topic_name"], conf["topic_format"], path=conf["topic_path"])
    else:
        options = {"kafka.bootstrap.servers": conf["bootstrap_servers"]}
        if conf["min_partitions"]:
            options["minPartitions"] = conf["min_partitions"]
        topic = TopicSpec(conf["topic_name"], options=options, partitions=conf["partitions"])
    output, offset = conf["output_dir_prefix"], conf["offset"]
    rebalance = conf["rebalance"] == 1
    split_events(spark, topic, output, offset, rebalance=rebalance, layout=conf["layout"])


if __name__ == "__main__":
    main()
