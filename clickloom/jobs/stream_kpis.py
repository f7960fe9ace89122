"""Hourly KPIs from a topic to a topic, until stopped.

Options: ``spark.kpis.topic_in``, ``.topic_out``, ``.checkpoint``,
``.bootstrap_servers``, ``.window``, ``.start`` (epoch milliseconds at which a
window begins, or ``earliest`` for the first event), ``.trigger``, ``.watermark``,
``.compact`` (1 keeps a file topic as compacted runs; default 0),
``.max_offsets`` (per micro-batch; bounds the first one on a full topic).
With ``.path_in`` and ``.path_out`` files stand in for the topics.
"""

from clickloom.jobs.session import job_session
from clickloom.plans import REQUIRED, job_conf, stream_kpis
from clickloom.sources import TopicSpec


def main() -> None:
    spark = job_session("stream-kpis")
    conf = job_conf(
        spark,
        "spark.kpis",
        {
            "topic_in": (str, REQUIRED),
            "topic_out": (str, REQUIRED),
            "checkpoint": (str, REQUIRED),
            "bootstrap_servers": (str, "localhost:9092"),
            "window": (str, "1 hour"),
            "trigger": (str, "5 seconds"),
            "watermark": (str, None),
            "start": (lambda text: text if text == "earliest" else int(text), None),
            "compact": (int, 0),
            "max_offsets": (str, None),
            "path_in": (str, None),
            "path_out": (str, None),
        },
    )
    servers = {"kafka.bootstrap.servers": conf["bootstrap_servers"]}

    rate = {"maxOffsetsPerTrigger": conf["max_offsets"]} if conf["max_offsets"] else {}

    def topic(name: str, path: str | None, file_format: str, **options: str) -> TopicSpec:
        if path is None:
            return TopicSpec(name, options=servers | options)
        return TopicSpec(name, file_format, path=path)

    stream_kpis(
        spark,
        topic(conf["topic_in"], conf["path_in"], "text", **rate),
        topic(conf["topic_out"], conf["path_out"], "parquet"),
        conf["checkpoint"],
        conf["window"],
        conf["trigger"],
        conf["watermark"],
        conf["start"],
        conf["compact"] == 1,
    ).awaitTermination()


if __name__ == "__main__":
    main()
