"""The engine as a command: build, finalise, discover, compare, validate and list.

python -m loomgraph build --config c.yaml --input 'Books=data/books*.jsonl' --out graphs [--limit 1000]
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.operators import profile
from loomgraph.plans.build import build, summary
from loomgraph.plans.config import Config
from loomgraph.sources import graphs, records


def _records(spark: SparkSession, pattern: str, limit: int | None, sample: int | None, id_field: str) -> DataFrame:
    """pid, ord, flat and, where records have them, images."""
    got = records.read_json_lines(spark, pattern.split(","))
    got = records.first_records(got, limit) if limit else got
    got = records.sampled(got, sample) if sample else got
    images = F.from_json(F.get_json_object("json", "$.images"), "array<map<string,string>>")
    return got.select(F.get_json_object("json", f"$.{id_field}").alias("pid"), F.col("row").alias("ord"), records.flat(F.col("json")).alias("flat"), F.coalesce(images, F.array().cast("array<map<string,string>>")).alias("images"))


def _attributes(products: DataFrame) -> DataFrame:
    a = products.select("pid", F.explode("flat").alias("e"))
    return a.select("pid", F.col("e.path").alias("key"), F.explode("e.values").alias("value"))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomgraph", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("build", "discover", "compare", "validate", "list"):
        c = sub.add_parser(name)
        c.add_argument("--config", required=name != "discover")
        if name in ("build", "discover", "compare"):
            c.add_argument("--input", action="append", required=True, help="files, for build and compare as CATEGORY=files")
            c.add_argument("--limit", type=int, help="only the first records of each category")
            c.add_argument("--sample", type=int, help="so many records, spread over all")
            c.add_argument("--id-field", default="parent_asin")
        if name == "build":
            c.add_argument("--out", required=True)
    f = sub.add_parser("finalise")
    f.add_argument("folder", nargs="+")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    config = Config.load(args.config) if getattr(args, "config", None) else None
    say = lambda x: print(json.dumps(x, ensure_ascii=False, default=str))
    if args.command == "list":
        for c in config.categories:
            plan = config.plan(c)
            say({"category": c, "relations": len(plan.relations), "two_passes": plan.two_passes})
        return 0
    if args.command == "validate":
        problems = config.validate()
        for x in [*config.alias_report(), *problems]:
            say(x)
        return 1 if problems else 0
    spark = spark or SparkSession.builder.appName("loomgraph").getOrCreate()
    if args.command == "finalise":
        for folder in args.folder:
            say(graphs.finalise(spark, folder).first().asDict())
        return 0
    whole = []
    for given in args.input:
        category, _, pattern = given.rpartition("=")
        products = _records(spark, pattern, args.limit, args.sample, args.id_field)
        if args.command == "build":
            plan = config.plan(category)
            graph = build(products, plan)
            graphs.write_graph(graph, f"{args.out}/{category}")
            whole.append(summary(graphs.read_graph(spark, f"{args.out}/{category}"), plan))
            say(whole[-1])
            continue
        attributes = _attributes(products)
        keys = profile.key_profile(attributes, products.count())
        if args.command == "discover":
            wanted = keys.filter("reasons = ''")
            print(profile.suggested(profile.redundancy(attributes, keys=wanted), keys))
        else:
            declared = [(s,) for r in config.plan(category).relations for s in r.sources]
            for r in profile.compared(keys, spark.createDataFrame(declared, "key string")).orderBy(F.desc("coverage"), "key").collect():  # keys are schema
                say(r.asDict())
    if args.command == "build":
        totals = {k: sum(s[k] for s in whole) for k in ("products", "triples", "texts", "images", "taxonomy_edges")}
        spark.createDataFrame([(json.dumps({"categories": whole, "totals": totals}, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(f"{args.out}/build_summary")
    return 0


if __name__ == "__main__":
    sys.exit(main())
