"""Build the feature table.

Options: ``spark.features.weblogs_path``, ``.users_items_dir``, ``.output``,
``.date`` (default: the newest snapshot), ``.n`` (vocabulary size), ``.wide``
(0: item counts as one map; default 1).
"""

from clickloom.jobs.session import job_session
from clickloom.plans import REQUIRED, build_features, job_conf
from clickloom.sources import latest_snapshot


def main() -> None:
    spark = job_session("features")
    conf = job_conf(
        spark,
        "spark.features",
        {
            "weblogs_path": (str, REQUIRED),
            "users_items_dir": (str, REQUIRED),
            "output": (str, REQUIRED),
            "date": (str, None),
            "n": (int, 1000),
            "wide": (lambda raw: int(raw) == 1, True),
        },
    )
    if conf["date"] is None:
        conf["date"] = latest_snapshot(spark, conf["users_items_dir"])
        if conf["date"] is None:
            raise ValueError("no dated snapshot in " + conf["users_items_dir"])
    build_features(spark, **conf)


if __name__ == "__main__":
    main()
