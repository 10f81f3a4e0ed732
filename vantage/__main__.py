"""Command line: run an insight spec or SQL over Parquet datasets and write the result as Parquet.

    python -m vantage insight spec.json --dataset orders=/data/orders --out /data/result
    python -m vantage sql "SELECT ... FROM '{{orders}}' WHERE x > :lo" --dataset orders=/data/orders \\
        --named lo=10 --out /data/result

Datasets are bound by id (``--dataset id=path``, repeatable) or found by id under ``--store ROOT``
(a ``DatasetStore``). sqlEditor specs take their variable
values from ``--var name=value``. The result is written by the executors (``--out``) or, without
``--out``, its first rows are printed.
"""

from __future__ import annotations

import argparse
import json
import sys

from vantage.plans.insight import run_insight
from vantage.plans.sql import execute_sql, placeholder_ids
from vantage.session import get_session
from vantage.sources.datasets import DatasetStore, read_dataset, write_dataset
from vantage.sources.tables import TableResolver


def _pairs(items: list[str], what: str) -> dict[str, str]:
    out = {}
    for item in items or []:
        if "=" not in item:
            raise SystemExit(f"{what} must look like name=value: {item!r}")
        k, v = item.split("=", 1)
        out[k] = v
    return out


def main(argv: list[str] | None = None, spark=None) -> int:
    parser = argparse.ArgumentParser(prog="python -m vantage", description=__doc__.splitlines()[0])
    parser.add_argument("mode", choices=["insight", "sql"])
    parser.add_argument("source", help="spec JSON file (insight) or SQL text (sql)")
    parser.add_argument("--dataset", action="append", default=[], help="id=parquet_path")
    parser.add_argument("--store", help="root folder of a DatasetStore; unbound ids are read from there")
    parser.add_argument("--var", action="append", default=[], help="SQL variable name=value (sqlEditor specs)")
    parser.add_argument("--arg", action="append", default=[], help="positional SQL argument (sql mode)")
    parser.add_argument("--named", action="append", default=[], help="named SQL argument name=value (sql mode)")
    parser.add_argument("--out", help="write the result here as Parquet")
    parser.add_argument("--show", type=int, default=20, help="rows to print when there is no --out")
    args = parser.parse_args(argv)

    spark = spark or get_session()
    bound = TableResolver(spark)
    for ds_id, path in _pairs(args.dataset, "--dataset").items():
        bound.bind(ds_id, read_dataset(spark, path))
    store = DatasetStore(spark, args.store) if args.store else None

    def resolver(ds_id: str):
        if ds_id in bound.bindings or store is None:
            return bound(ds_id)
        return store(ds_id)

    if args.mode == "insight":
        with open(args.source) as fh:
            spec = json.load(fh)
        df = run_insight(spec, resolver, variables=_pairs(args.var, "--var") or None, spark=spark)
    else:
        named = _pairs(args.named, "--named")
        df = execute_sql(spark, args.source, placeholder_ids(args.source), resolve=resolver,
                         args=args.arg or None, named_args=named or None)
    if args.out:
        write_dataset(df, args.out)
        print(args.out)
    else:
        for row in df.take(args.show):
            print(json.dumps(row.asDict(), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
