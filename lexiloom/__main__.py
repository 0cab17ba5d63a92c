"""python -m lexiloom COMMAND --folder FOLDER: commands over a build's folder."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions import variants as va
from lexiloom.operators import evaluate as ev
from lexiloom.operators import judgement as ju
from lexiloom.operators import sync as sy
from lexiloom.plans import review
from lexiloom.plans.build import Build, Config
from lexiloom.session import ship
from lexiloom.sources import readers as rd
from lexiloom.sources import writers as wr

#: Further options of each command.
OPTIONS = {
    "build": ("pages", "answers", "types", "neighbors", "proposals", "stopwords", "excluded"), "collect": ("pages",), "rebuild": (), "runs": (), "export": (), "impact": ("terms!", "pairs!"),
    "prompts": ("kind!",), "replay": ("kind!", "answers!"), "apply": ("terms", "relations"), "gold-sample": ("out!", "size"), "gold": ("labels!",), "tune": ("neighbors!",), "validate": ("docs!", "key", "title", "category"),
    "variants": ("docs!", "out!", "rules", "column"),
}
FLAGS = {"build": ("skip-collect", "skip-llm", "skip-classification"), "apply": ("dry-run",)}
#: Columns of the sheet of relations.
SHEET = (
    "remove", "display_a", "display_b", "similarity", "sources", "rank_ab", "rank_ba", "priority", "relation_type", "confidence", "state",
    "expandable", "hint", "reason", "a", "b", "pair_key",
)
HELP = {
    "pages": "a table of pages", "answers": "a table (build) or folder (replay) of stored answers", "types": "a table of term types", "neighbors": "a table of neighbours (term, other, similarity, rank)",
    "proposals": "a table of proposed pairs (a, b, score)", "kind": "classify, propose or judge", "terms": "a sheet or list of terms", "relations": "a sheet of relations", "pairs": "a list of pairs",
    "rules": "a JSON list of rules of variants", "docs": "a table of documents", "stopwords": "a list of words that are no terms", "excluded": "a list of pairs that are never candidates",
}


def parser() -> argparse.ArgumentParser:
    """-c is taken before or after the command."""
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("-c", "--config", default=argparse.SUPPRESS, help="settings (JSON, or YAML where its library is there)")
    top = argparse.ArgumentParser(prog="lexiloom", parents=[common])
    sub = top.add_subparsers(dest="command", required=True)
    for name, options in OPTIONS.items():
        p = sub.add_parser(name, parents=[common])
        p.add_argument("--folder", required=True)
        for o in options:
            p.add_argument(f"--{o.rstrip('!')}", required=o.endswith("!"), help=HELP.get(o.rstrip("!")), choices=("classify", "propose", "judge") if o == "kind!" else None)
        for flag in FLAGS.get(name, ()):
            p.add_argument(f"--{flag}", action="store_true")
    return top


def export(build: Build) -> None:
    """Sheets of the terms that are in a pair, most frequent first, and of the pairs, best first."""
    pairs, judged = build.get("candidates"), build.has("relations")  # before anything is judged, all pairs are unjudged
    terms = build.get("typed_terms" if judged else "terms")
    none = "source string, target string, relation_type string, confidence string, status string, safe_expansion boolean, reason string"
    relations = build.get("relations") if judged else build.spark.createDataFrame([], none)
    contexts = build.get("contexts").withColumn("rank", F.col("rank") - 1)
    sheet = ev.terms_sheet(ju.involved(terms, pairs), pairs, build.get("patterns"), contexts)
    wr.write_sheet(sheet.drop("excluded_reason").orderBy(F.desc("frequency"), "term"), f"{build.folder}/terms_sheet", "errorifexists")
    sheet = ev.relations_sheet(pairs, relations, terms).select(*SHEET).orderBy(F.desc("priority"), "a", "b")
    wr.write_sheet(sheet, f"{build.folder}/relations_sheet", "errorifexists")


def run(build: Build, args: argparse.Namespace) -> list[DataFrame]:
    """Does a command and gives what it has to show."""
    read = lambda p: build.spark.read.parquet(p) if p else None
    if args.command == "collect":
        return [build.collect(read(args.pages))]
    if args.command == "build":
        answers, types = None if args.skip_llm else read(args.answers), None if args.skip_classification else read(args.types)
        paths = {k: read(getattr(args, k)) for k in ("neighbors", "proposals") if getattr(args, k)}
        if args.stopwords:
            build.config.stopwords = (*build.config.stopwords, *(r["word"] for r in rd.read_list(build.spark, args.stopwords).collect()))
        if args.excluded:
            paths["excluded"] = rd.read_excluded_pairs(build.spark, args.excluded)
        return [build.run(None if args.skip_collect else read(args.pages), answers, types, **paths)]
    if args.command == "rebuild":
        return [build.rebuild().agg(F.count(F.lit(1)).alias("entries"))]
    if args.command == "runs":
        return [build.spark.read.option("mergeSchema", True).parquet(f"{args.folder}/runs/*").orderBy(F.desc("run_id")).limit(10)]
    if args.command == "export":
        export(build)
        return []
    if args.command == "impact":
        gone = rd.read_list(build.spark, args.terms).select(F.col("word").alias("term"))
        return [sy.removal_impact(build.get("relations"), gone, rd.read_excluded_pairs(build.spark, args.pairs))]
    if args.command == "prompts":
        return [build.prompts(args.kind)]
    if args.command == "replay":
        return [build.replay(args.kind, args.answers)]
    if args.command == "apply":
        return [review.apply_sheets(build, args.terms, args.relations, args.dry_run)]
    if args.command == "gold-sample":
        return [review.gold_sample(build, int(args.size or 100), args.out)]
    if args.command == "gold":
        return [review.gold_figures(build, args.labels)]
    if args.command == "tune":
        return list(review.tune(build, read(args.neighbors)))
    if args.command == "variants":
        rules = "\n".join(r[0] for r in build.spark.read.text(args.rules).collect()) if args.rules else None  # a file that people make
        return [review.vary(read(args.docs), args.out, va.rules_of(rules), args.column or "body")]
    return [review.validate(read(args.docs), args.key or "doc_id", args.title, args.category)]


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("lexiloom").getOrCreate()
    ship(spark)
    options = {}
    if getattr(args, "config", None):
        text = "\n".join(r[0] for r in spark.read.text(args.config).collect())  # a settings file, a line to a row
        options = rd.load_settings(text).get("build", {})
    config = Config(**{k: tuple(v) if isinstance(v, list) else v for k, v in options.items()})
    for df in run(Build(spark, args.folder, config), args):
        df.show()


if __name__ == "__main__":
    main()
