"""python -m kaghamar prepare|tokenize|chat ...: the end-to-end runs from the command line."""

from __future__ import annotations

import argparse

from kaghamar.plans import pipelines
from kaghamar.session import build_session


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="kaghamar", description=__doc__)
    parser.add_argument("--master", default="local[*]")
    runs = parser.add_subparsers(dest="run", required=True)
    prepare = runs.add_parser("prepare", help="sources to a deduplicated corpus")
    prepare.add_argument("--source", action="append", required=True, metavar="NAME=PATH")
    prepare.add_argument("--no-dedup", action="store_true")
    text = runs.add_parser("tokenize", help="a Parquet column to character tokens")
    text.add_argument("--input", required=True)
    text.add_argument("--key", default="para_id")
    text.add_argument("--text", default="text")
    chat = runs.add_parser("chat", help="pair files, best first, to chat tokens")
    chat.add_argument("--input", action="append", required=True)
    for run in (prepare, text, chat):
        run.add_argument("--out", required=True)
    told = parser.parse_args(args)
    spark = build_session(told.master)
    if told.run == "prepare":
        pipelines.prepare_corpus(spark, dict(s.split("=", 1) for s in told.source), told.out, not told.no_dedup).show(truncate=False)
    elif told.run == "tokenize":
        pipelines.tokenize(spark.read.parquet(told.input), told.key, told.text, told.out).show()
    else:
        pairs = pipelines.merge_instructions([spark.read.json(p, schema="instruction string, input string, output string, source string") for p in told.input])
        pipelines.prepare_chat(pairs, told.out).show()


if __name__ == "__main__":
    main()
