"""Command lines of the data plane: ``python -m quern.cli COMMAND ...``.  Each prints one JSON line about what it did."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from quern.operators import artifacts, blocks
from quern.operators.clients import TeacherConfig, ready
from quern.operators.contract import TEACHER_RECORD
from quern.plans import bank as banks
from quern.plans import shards as shard_plan
from quern.plans import teacher
from quern.session import session
from quern.sources import readers, writers

ROW = (
    "prompt string, instruction string, question string, query string, input string, `user` string, title string, context string, document string, passage string, "
    f"article string, text string, content string, body string, code string, messages {readers.MESSAGE}, conversations {readers.MESSAGE}"
)
PROMPT = "id string, source string, role string, modality string, prompt_text string, context_text string, media map<string,array<string>>, metadata map<string,string>, position bigint"


def bank(spark, a) -> dict:
    """Prompt records from the sources of a configuration."""
    sources = [r.asDict() for r in readers.read_sources(spark, a.config).orderBy("source_order").collect()]
    rows, failed = banks.prompt_bank(spark, sources, ROW, a.manifests, a.source, a.mirrors, a.per_source, a.total, a.max_chars)
    return writers.write_jsonl(rows.orderBy("position"), a.output) | {"failures": failed}


def generate(spark, a) -> dict:
    """Teacher records for a bank of prompt records."""
    prompts = readers.read_jsonl(spark, a.input, PROMPT)
    config = TeacherConfig(runtime=a.runtime, model=a.model, base_url=a.base_url, max_tokens=a.max_tokens)
    return {"records": teacher.run(prompts, config, a.output, ["position"], a.target_tokens, a.chunk, a.quarantine)}


def shards(spark, a) -> dict:
    """Noised block shards from teacher records."""
    records = readers.read_jsonl(spark, a.input, TEACHER_RECORD)
    rows = shard_plan.build_shards(records, a.blocks, a.canvas, a.prefix, a.shard_blocks, a.seed, a.order, make_tokenizer=blocks.rank_file_tokenizer(a.tokenizer) if a.tokenizer else None)
    writers.write_shards(rows, a.output)
    totals = blocks.corruption_totals(readers.read_shards(spark, a.output))
    options = {"target_blocks": a.blocks, "canvas_length": a.canvas, "prefix_length": a.prefix, "tokenizer": a.tokenizer, "record_order": a.order, "seed": a.seed}
    totals = totals.select("*", *[F.lit(v).alias(k) for k, v in options.items()])
    writers.write_report(totals, f"{a.output.rstrip('/')}-progress")
    return totals.first().asDict()


def verify(spark, a) -> dict:
    """Checks of written shards."""
    return blocks.verify_shards(readers.read_shards(spark, a.input), a.canvas, a.min_blocks).first().asDict()


def check(spark, a) -> dict:
    """Which files of a model's folder are there."""
    return artifacts.artifact_report(readers.read_files(spark, a.input)).first().asDict()


def bundle(spark, a) -> dict:
    """Files of a folder with their checksums in one archive."""
    return writers.write_bundle(readers.read_files(spark, a.input), a.output, a.input)


def presets(spark, a) -> dict:
    """A preset as JSON or shell assignments."""
    print(writers.presets(a.name, a.style))
    return {}


def probe(spark, a) -> dict:
    """Whether a server is ready."""
    return {"ready": ready(a.url)}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quern")
    commands = p.add_subparsers(dest="command", required=True)

    def add(f, *needed: str, **options):
        c = commands.add_parser(f.__name__, help=f.__doc__)
        for n in needed:
            c.add_argument(f"--{n}", required=True)
        for n, v in options.items():
            c.add_argument(f"--{n.replace('_', '-')}", **({"default": v, "type": type(v)} if v is not None else {"default": None}))
        c.set_defaults(run=f, session=f not in (presets, probe))
        return c

    add(bank, "config", "output", manifests="data/manifests", mirrors=None, per_source=0, total=0, max_chars=12_000).add_argument("--source", action="append")
    add(generate, "input", "output", runtime="lmstudio", model="", base_url="", max_tokens=2048, target_tokens=0, chunk=10_000, quarantine=None)
    add(shards, "input", "output", tokenizer=None, blocks=200_000, canvas=256, prefix=512, shard_blocks=4096, seed=1337, order="shuffled")
    add(verify, "input", canvas=256, min_blocks=0)
    add(check, "input")
    add(bundle, "input", "output")
    add(presets, name="gpu", style="json")
    add(probe, "url")
    return p


def main(arguments: list[str] | None = None) -> int:
    a = parser().parse_args(arguments)
    done = a.run(session("quern") if a.session else None, a)
    if done:
        print(json.dumps(done, ensure_ascii=False, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
