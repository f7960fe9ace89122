"""Rank domains for a segment.

Options: ``spark.affinity.log_path``, ``.segment_path``, ``.output``, ``.k``,
``.multi_line`` (1: the segment document spans several lines; default 0).
"""

from clickloom.jobs.session import job_session
from clickloom.plans import REQUIRED, job_conf, rank_domains


def main() -> None:
    spark = job_session("affinity")
    conf = job_conf(
        spark,
        "spark.affinity",
        {
            "log_path": (str, REQUIRED),
            "segment_path": (str, REQUIRED),
            "output": (str, REQUIRED),
            "k": (int, 200),
            "multi_line": (lambda raw: int(raw) == 1, False),
        },
    )
    rank_domains(spark, **conf)


if __name__ == "__main__":
    main()
