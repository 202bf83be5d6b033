"""Print the formatted physical plan of registered queries (plan review aid).

usage: python scripts/show_plans.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from recspark.plans import REGISTRY  # noqa: E402
from recspark.session import local_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1]
    spark = local_session(8)
    for name in sys.argv[2:]:
        df = REGISTRY[name].fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()  # final AQE plan
        print(f"===== {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
