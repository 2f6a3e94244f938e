"""``python -m siltmill STAGE name=value ...``: runs a stage; lists are comma-separated."""

from __future__ import annotations

import inspect
import sys
import typing

from pyspark.sql import SparkSession

from siltmill.plans.stages import STAGES


def _value(kind: object, text: str):
    if typing.get_origin(kind) is list:
        return text.split(",")
    kinds = [k for k in (typing.get_args(kind) or (kind,)) if k is not type(None)]
    if bool in kinds:
        return text.lower() in ("1", "true", "yes")
    return next((k for k in (int, float) if k in kinds), str)(text)


def main(args: list[str]) -> int:
    if not args or args[0] not in STAGES:
        print(__doc__, "stages:", ", ".join(STAGES))
        return 2
    stage = STAGES[args[0]]
    kinds = typing.get_type_hints(stage)
    given = dict(a.split("=", 1) for a in args[1:])
    unknown = set(given) - set(inspect.signature(stage).parameters)
    if unknown:
        print("unknown:", ", ".join(sorted(unknown)))
        return 2
    spark = SparkSession.builder.appName(f"siltmill {args[0]}").getOrCreate()
    print(stage(spark, **{k: _value(kinds[k], v) for k, v in given.items()}))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
