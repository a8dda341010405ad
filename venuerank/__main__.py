"""Command line: ``python -m venuerank run|evaluate|copy``."""

from __future__ import annotations

import argparse
import datetime

from venuerank import schemas
from venuerank.operators import classifier, recommend
from venuerank.plans.batch import STAGES, BatchOptions, run_batch
from venuerank.session import build_session, materialise, release_scratch
from venuerank.sinks.writers import copy_tables, jdbc_settings, ready_for_serving, write_jdbc
from venuerank.sources.raw import labelled_text, read_table


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="venuerank")
    parser.add_argument("--master", help="Spark master, for runs outside spark-submit")
    commands = parser.add_subparsers(dest="command", required=True)

    run = commands.add_parser("run", help="raw records to gold tables")
    run.add_argument("--input", required=True)
    run.add_argument("--output", required=True)
    run.add_argument("--as-of", default=str(datetime.date.today()))
    run.add_argument("--stages", nargs="+", choices=STAGES, default=list(STAGES))
    run.add_argument("--business-file", default="business.json")
    run.add_argument("--review-file", default="review.json")
    run.add_argument("--rank", type=int, default=recommend.RANK)
    run.add_argument("--max-iter", type=int, default=recommend.ITERATIONS)
    run.add_argument("--reg-param", type=float, default=recommend.REGULARISATION)
    run.add_argument("--cv", action="store_true", help="choose rank and regularisation by cross-validation")
    run.add_argument("--to-database", action="store_true", help="also replace the tables of the serving database")

    for command in (run, evaluate := commands.add_parser("evaluate", help="model figures from the tables of a run")):
        command.add_argument("--sample-rows", type=int, help="most rows the text classifier is fitted on, all unless given")
        command.add_argument("--vocabulary", type=int, default=classifier.VOCABULARY_SIZE, help="most terms it knows")

    copy = commands.add_parser("copy", help="load tables of a run into the serving database")
    copy.add_argument("--input", required=True, help="output folder of a run")
    copy.add_argument("--tables", nargs="+", choices=list(schemas.PRIMARY_KEYS), default=list(schemas.PRIMARY_KEYS))

    evaluate.add_argument("--input", required=True, help="output folder of a run")
    evaluate.add_argument("--mode", choices=["als", "sentiment", "all"], default="all")
    evaluate.add_argument("--k", type=int, default=10)
    return parser


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = build_session(master=args.master)
    if args.command == "run":
        options = BatchOptions(
            raw=args.input, output=args.output, as_of=args.as_of, stages=tuple(args.stages),
            business_file=args.business_file, review_file=args.review_file, rank=args.rank,
            max_iter=args.max_iter, reg_param=args.reg_param, cross_validate=args.cv, to_database=args.to_database,
            sample_rows=args.sample_rows, vocabulary=args.vocabulary,
        )
        for table, rows in run_batch(spark, options).items():
            print(f"{table}: {rows:,} rows")
    elif args.command == "copy":
        settings = jdbc_settings()
        copied = copy_tables(
            args.tables, lambda name: ready_for_serving(read_table(spark, args.input, name), name),
            lambda df, name: write_jdbc(df, name, settings),
        )
        print(f"copied: {', '.join(copied) or 'nothing'}")
    else:
        if args.mode in ("als", "all"):
            read_table(spark, args.input, "als_rmse").show()
            recommendations = read_table(spark, args.input, "als_recommendations")
            recommend.predicted_precision_at_k(recommendations, args.k).show()
        if args.mode in ("sentiment", "all"):
            reviews = labelled_text(read_table(spark, args.input, "reviews_enriched"))
            predictions = materialise(classifier.predict_held_out(reviews, args.sample_rows, args.vocabulary), "predictions")
            classifier.classification_metrics(predictions).show()
            classifier.confusion_matrix(predictions).show()
    release_scratch(spark)


if __name__ == "__main__":
    main()
