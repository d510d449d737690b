"""``spark-submit`` entry: analyse a folder of input files, save and show the results."""

import argparse

from pyspark.sql import SparkSession

from cardwarden.report import run
from cardwarden.sources.files import SourcePaths


def main() -> None:
    parser = argparse.ArgumentParser(prog="cardwarden", description=__doc__)
    parser.add_argument("sources", help="folder with the three CSV and two JSON files")
    parser.add_argument("output", help="folder for staged tables and results")
    parser.add_argument(
        "--show", type=int, default=0, metavar="N", help="print N rows of each analysis"
    )
    options = parser.parse_args()
    spark = SparkSession.builder.appName("cardwarden").getOrCreate()
    results = run(spark, SourcePaths.under(options.sources), options.output)
    if options.show:
        for name, rows in results.items():
            print(name)
            rows.show(options.show, truncate=False)


if __name__ == "__main__":
    main()
