"""The two jobs from the command line; run with spark-submit or ``python -m wordkin``."""

from __future__ import annotations

import argparse

from wordkin.metrics import observe_rows
from wordkin.operators.ngrams import FIRST_YEAR, LAST_YEAR, parse_ngrams
from wordkin.plans.collocations import extract_collocations, step_counts
from wordkin.plans.reviews import run_reviews
from wordkin.session import build_session
from wordkin.sinks.tables import write_collocations
from wordkin.sources.ngrams import read_sequence_lines, read_stop_words, read_text_lines
from wordkin.storage import files_fingerprint, is_complete, pin, scratch_folder


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="wordkin")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("collocations", help="collocations per decade from 2-gram counts")
    job.add_argument("min_npmi", type=float)
    job.add_argument("min_rel", type=float)
    job.add_argument("--input", nargs="+", required=True, help="files or folders of 2-gram lines")
    job.add_argument("--format", choices=["text", "sequence"], default="text")
    job.add_argument("--stop-words", required=True, help="one word per line")
    job.add_argument("--output", required=True)
    job.add_argument("--start", type=int, default=FIRST_YEAR)
    job.add_argument("--end", type=int, default=LAST_YEAR)
    job.add_argument("--sum-mode", choices=["truncated", "exact"], default="truncated")
    job.add_argument("--work-dir", help="keep intermediate tables here and resume from them")

    job = jobs.add_parser("reviews", help="sentiment, entities and sarcasm of product reviews")
    job.add_argument("paths", nargs="+", help="input paths, then as many output names")
    job.add_argument("--lexicon", required=True, help="tab-separated: word, polarity")
    job.add_argument("--gazetteer", required=True, help="tab-separated: word, type")
    job.add_argument("--output", required=True, help="folder of the JSON lines and HTML reports")
    job.add_argument("--charset-fallback", action="store_true", help="read files that are not UTF-8 as ISO-8859-1")
    job.add_argument("--no-escape", action="store_true", help="write link and entities into the HTML as they are")

    options = parser.parse_args(argv)
    if options.job == "reviews" and len(options.paths) % 2:
        parser.error("give one output name per input path")
    return options


def main(argv: list[str] | None = None) -> None:
    options = _arguments(argv)
    spark = build_session(f"wordkin-{options.job}")
    if options.job == "collocations":
        read = read_sequence_lines if options.format == "sequence" else read_text_lines
        work_dir = options.work_dir or scratch_folder(spark, "collocations")
        seen = {}

        def observe(table, step):
            if step in ("lines", "valid", "kept"):
                table, seen[step] = observe_rows(table, step)
            # the corpus is parsed once; its records are read twice
            return pin(table, "kept", codec="zstd") if step == "kept" and not begun else table

        begun = is_complete(spark, f"{work_dir}/pairs")
        valid = observe(parse_ngrams(observe(read(spark, options.input), "lines")), "valid")
        found = extract_collocations(
            valid, read_stop_words(spark, options.stop_words), options.min_npmi, options.min_rel,
            options.start, options.end, sum_mode=options.sum_mode, work_dir=work_dir, ordered=False,
            inputs=files_fingerprint(spark, options.input), observe=observe)
        write_collocations(found, options.output)
        if not begun:
            # a run that takes up finished tables does not read the corpus again
            first = spark.createDataFrame([(step, rows.get["rows"]) for step, rows in seen.items()], "step string, rows bigint")
            first.coalesce(1).write.mode("overwrite").json(f"{work_dir}/read")
        counts = {row.step: row.rows for row in spark.read.schema("step string, rows bigint").json(f"{work_dir}/read").collect()}
        counts |= step_counts(spark, work_dir)
        print(", ".join(f"{step} {rows}" for step, rows in counts.items()))
        print(f"found {spark.read.text(options.output).count()}")
    else:
        half = len(options.paths) // 2
        if len(set(options.paths[:half])) < half or len(set(options.paths[half:])) < half:
            raise SystemExit("each input and each output name may be given once")
        table = spark.read.option("sep", "\t").option("quote", "")
        run_reviews(spark, dict(zip(options.paths[:half], options.paths[half:])), options.output,
                    table.schema("word string, polarity int").csv(options.lexicon),
                    table.schema("word string, type string").csv(options.gazetteer),
                    options.charset_fallback, not options.no_escape)
        print(f"products {spark.read.text(f'{options.output}/json').count()}, "
              f"quarantined {spark.read.parquet(f'{options.output}/quarantine').count()}")


if __name__ == "__main__":
    main()
