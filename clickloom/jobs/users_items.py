"""Update the users x items matrix.

Options: ``spark.users_items.update`` (1 merges into the newest snapshot, 0
starts anew; default 1), ``.input_dir``, ``.output_dir``, ``.same_date``
(``replace`` or ``add``), ``.wide`` (0 keeps the long counts only; default 1),
``.since`` (first input date to read, ``yyyyMMdd``).
"""

from clickloom.jobs.session import job_session
from clickloom.plans import REQUIRED, job_conf, update_users_items


def main() -> None:
    spark = job_session("users-items")
    conf = job_conf(
        spark,
        "spark.users_items",
        {
            "update": (int, 1),
            "input_dir": (str, REQUIRED),
            "output_dir": (str, REQUIRED),
            "same_date": (str, "replace"),
            "wide": (int, 1),
            "since": (str, None),
        },
    )
    update_users_items(
        spark,
        conf["input_dir"],
        conf["output_dir"],
        conf["update"] == 1,
        conf["same_date"],
        conf["wide"] == 1,
        conf["since"],
    )


if __name__ == "__main__":
    main()
