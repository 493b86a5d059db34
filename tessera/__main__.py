"""Command line: ``python -m tessera build ...`` runs the pipeline from landed files,
``python -m tessera ingest ...`` appends newly landed files to a bronze folder."""

from __future__ import annotations

import argparse


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tessera")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="landing CSVs -> bronze, silver, gold tables")
    b.add_argument("--crimes", required=True)
    b.add_argument("--socioeconomic", required=True)
    b.add_argument("--iucr-codes", required=True)
    b.add_argument("--no-comments", action="store_true")
    i = sub.add_parser("ingest", help="incremental landing folder -> bronze parquet folder")
    i.add_argument("--landing", required=True)
    i.add_argument("--target", required=True)
    i.add_argument("--source", required=True)
    i.add_argument("--checkpoint")
    args = ap.parse_args(argv)

    from tessera.session import get_session
    spark = get_session()
    if args.cmd == "build":
        from tessera.plans import crimes
        tables = crimes.build(spark, {"crimes": args.crimes, "socioeconomic": args.socioeconomic,
                                      "iucr_codes": args.iucr_codes},
                              comments=not args.no_comments)
        for name in tables:
            print(name)
    else:
        from tessera.streaming import ingest_landing
        ingest_landing(spark, args.landing, args.target, args.source, checkpoint=args.checkpoint)


if __name__ == "__main__":
    main()
