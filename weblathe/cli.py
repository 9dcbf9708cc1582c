"""Command line: ``python -m weblathe.cli process|aggregate|analyze|distribute BASE [--rules FILE]``."""

from __future__ import annotations

import argparse

from .functions.formats import FILTERED_DOMAINS
from .operators.suffix import FALLBACK_RULES, read_rules
from .plans import stages
from .session import get_spark
from .sources.logs import LOG_PREFIXES


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="weblathe")
    parser.add_argument("stage", choices=("process", "aggregate", "analyze", "distribute"))
    parser.add_argument("base")
    parser.add_argument("--rules", help="a public suffix list; without it, a small built-in set")
    parser.add_argument("--compat", action="store_true", help="read program prefixes and trailing dots as the older tool did")
    parser.add_argument("--log-prefix", action="append", help="what names of log files begin with; may be given several times")
    parser.add_argument("--filter-domain", action="append", default=[], help="a domain that the filtered outputs leave out; may be given several times")
    args = parser.parse_args(argv)
    spark = get_spark()
    rules = read_rules(spark, args.rules) if args.rules else FALLBACK_RULES
    if args.stage == "process":
        print(stages.process(spark, args.base, rules, compat=args.compat, prefixes=args.log_prefix or LOG_PREFIXES))
    elif args.stage == "aggregate":
        stages.aggregate(spark, args.base)
    elif args.stage == "analyze":
        stages.analyze(spark, args.base, rules, (*FILTERED_DOMAINS, *args.filter_domain))
    else:
        stages.distribute(spark, args.base)


if __name__ == "__main__":
    main()
