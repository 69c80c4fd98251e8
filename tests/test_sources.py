import base64
import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from quern import cli
from quern.operators import blocks
from quern.plans import bank, teacher
from quern.operators.clients import Offline, TeacherConfig
from quern.sources import images, readers, writers
from quern.storage import drop_all, prefix_sums, stored, up_to


def png(rows, colour, channels, filters):
    """A PNG of rows of bytes, each filtered as asked."""
    raw, above = b"", bytes(len(rows[0]))
    for row, kind in zip(rows, filters):
        out = []
        for x, v in enumerate(row):
            left, up, corner = (row[x - channels], above[x], above[x - channels]) if x >= channels else (0, above[x], 0)
            p = left + up - corner
            nearest = min(((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner)))[2]
            out.append((v - (0, left, up, (left + up) // 2, nearest)[kind]) % 256)
        raw += bytes([kind, *out])
        above = row
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    head = struct.pack(">IIBBBBB", len(rows[0]) // channels, len(rows), 8, colour, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_images():
    rows = [bytes((x * 7 + y * 31) % 256 for x in range(12)) for y in range(5)]
    assert images.decode(png(rows, 2, 3, [0, 1, 2, 3, 4])) == (5, 4, b"".join(rows))
    grey = images.decode(png([b"\x01\x02", b"\x03\x04"], 0, 1, [1, 4]))
    assert grey == (2, 2, bytes([1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4]))
    assert images.decode(b"P6\n# c\n1 1\n255\nabc") == (1, 1, b"abc")
    assert images.decode(b"P6\n9 9\n255\nabc") is None and images.decode(b"GIF89a") is None and images.decode(None) is None and images.decode(b"\x89PNG\r\n\x1a\n") is None


def test_checkpoint_pointer(tmp_path):
    assert readers.latest_checkpoint(str(tmp_path)) is None
    (tmp_path / "step-3").mkdir()
    (tmp_path / "latest_checkpoint.txt").write_text("step-3\n")
    assert readers.latest_checkpoint(str(tmp_path)) == f"{tmp_path}/step-3"
    (tmp_path / "latest_checkpoint.txt").write_text(str(tmp_path / "step-3"))
    assert readers.latest_checkpoint("file:" + str(tmp_path)) == f"{tmp_path}/step-3"
    (tmp_path / "latest_checkpoint.txt").write_text("gone")
    assert readers.latest_checkpoint(str(tmp_path)) is None


def test_base_config(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"text_config": {"hidden_size": 3}}, indent=1))
    (tmp_path / "d.json").write_text("{}")
    c = readers.read_base_config(spark, str(tmp_path / "c.json")).select(F.variant_get("config", "$.text_config.hidden_size", "int")).first()
    assert c[0] == 3
    with pytest.raises(Exception, match="no text_config"):
        readers.read_base_config(spark, str(tmp_path / "d.json")).collect()


def test_a_bad_line_stops_its_file_only(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"prompt": "1"}\n{"prompt": "2"}\n{"prompt": \n{"prompt": "4"}\n')
    (tmp_path / "b.jsonl").write_text('{"prompt": "5"}\n\n{"prompt": "6", "more": 1}\n')
    sources = [{"id": "A", "name": "a"}, {"id": "B", "name": "b"}, {"id": "C", "name": "c"}]
    rows, failed = readers.read_manifests(spark, sources, "prompt string", str(tmp_path))
    assert sorted((r["source_id"], r["source_order"], r["prompt"]) for r in rows.collect()) == [("A", 0, "1"), ("A", 0, "2"), ("B", 1, "5"), ("B", 1, "6")]
    assert sorted(f["source"] for f in failed) == ["A", "C"]
    records, failed = bank.prompt_bank(spark, sources, "prompt string", str(tmp_path))
    assert [r["prompt_text"] for r in records.orderBy("position").collect()] == ["1", "5", "2", "6"] and len(failed) == 2
    assert bank.prompt_bank(spark, [{**s, "enabled": s["id"] == "B"} for s in sources], "prompt string", str(tmp_path), total=1)[0].count() == 1
    with pytest.raises(RuntimeError):
        bank.prompt_bank(spark, sources[2:], "prompt string", str(tmp_path))


def test_mirrors_that_are_missing_are_reported(spark, tmp_path):
    spark.createDataFrame([("x",), ("",)], "prompt string").write.parquet(str(tmp_path / "A" / "train"))
    rows, failed = bank.prompt_bank(spark, [{"id": "A"}, {"id": "B"}], "prompt string", str(tmp_path), mirrors=str(tmp_path))
    assert [r["prompt_text"] for r in rows.collect()] == ["x"] and [f["source"] for f in failed] == ["B"]


def test_generation_ends_with_a_quarantine(spark, tmp_path):
    class Silent(Offline):
        def generate(self, prompt, content=None):
            return "" if prompt.endswith("1") else super().generate(prompt, content)

    rows = [(f"p{k:02d}", "s", "text", f"prompt {k}", None) for k in range(22)] + [("p03", "s", "text", "prompt 3", None), (None, "s", "text", "x", None), ("q", "s", "text", " ", None)]
    df = spark.createDataFrame(rows, "id string, source string, modality string, prompt_text string, context_text string").withColumn("media", F.lit(None).cast("map<string,array<string>>")).withColumn("metadata", F.lit(None).cast("map<string,string>"))
    out, bad = str(tmp_path / "o"), str(tmp_path / "q")
    assert teacher.run(df, TeacherConfig(runtime="offline"), out, ["id"], chunk=5, quarantine=bad, make=Silent) == 19
    assert teacher.run(df, TeacherConfig(runtime="offline"), out, ["id"], chunk=5, quarantine=bad, make=Silent) == 0
    assert spark.read.json(out).count() == 19 and spark.read.json(bad).count() == 3


def test_rank_file_tokenizer(spark, tmp_path):
    tokens = [bytes([k]) for k in range(256)] + [b"th", b"the", b" t"]
    p = tmp_path / "r.tiktoken"
    p.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(k).encode() for k, t in enumerate(tokens)))
    df = spark.createDataFrame([(1, "the tin"), (2, None), (3, "")], "id int, text string")
    got = {r["id"]: list(r["ids"]) for r in blocks.tokenized(df, "text", "ids", blocks.rank_file_tokenizer(str(p))).collect()}
    assert b"".join(tokens[k] for k in got[1]) == b"the tin" and got[1][0] == 257 and got[2] == got[3] == []


def test_media_that_cannot_be_processed_names_its_record(spark):
    df = spark.createDataFrame([(7, "a b", "m")], "id int, text string, media string")
    with pytest.raises(Exception, match="media of record 7"):
        blocks.encoder_inputs(df, "id", "text", "media", 4, 0, lambda: lambda t: [[1]], lambda: None).collect()
    assert list(blocks.encoder_inputs(df, "id", "text", None, 4, 9, lambda: lambda t: [[1, 2]]).first()["prefix_ids"]) == [9, 9, 1, 2]


def test_tables_are_dropped(spark):
    df = stored(spark.range(3))
    assert df.count() == 3
    drop_all(spark)
    with pytest.raises(Exception):
        spark.read.parquet(df.inputFiles()[0]).count()


def test_rows_up_to_a_key_with_nulls(spark):
    rows = [(None, 2), (None, None), (1, None), (1, 5), (2, 1), (0, 9)]
    df = spark.createDataFrame(rows, "a int, b int")
    key = lambda r: tuple((0, 0) if x is None else (1, x) for x in r)
    for last in rows:
        row = df.where(F.col("a").eqNullSafe(F.lit(last[0])) & F.col("b").eqNullSafe(F.lit(last[1]))).first()
        assert sorted(map(key, map(tuple, up_to(df, ["a", "b"], row).collect()))) == sorted(key(r) for r in rows if key(r) <= key(last))
    assert up_to(df, ["a"], None).count() == 0
    assert prefix_sums(df.withColumn("extra", F.lit("x")), ["a", "b"]).columns == ["a", "b", "ordinal"]


def test_command_lines(spark, tmp_path, capsys):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "one.jsonl").write_text("".join(json.dumps({"question": f"what is {k}?", "text": "some words here"}) + "\n" for k in range(6)))
    (tmp_path / "c.json").write_text(json.dumps({"sources": [{"id": "one", "manifest_only": True}]}))
    at = lambda n: str(tmp_path / n)
    said = lambda: json.loads(capsys.readouterr().out.strip().split("\n")[-1])
    cli.main(["bank", "--config", at("c.json"), "--manifests", at("m"), "--output", at("bank"), "--total", "5"])
    assert said()["records"] == 5
    cli.main(["generate", "--input", at("bank"), "--output", at("records"), "--runtime", "offline"])
    assert said()["records"] == 5
    cli.main(["shards", "--input", at("records"), "--output", at("shards"), "--canvas", "4", "--prefix", "4", "--shard-blocks", "3"])
    totals = said()
    assert totals["records_read"] == 5 and totals["blocks_written"] == 10 and totals["shards"] == 4
    cli.main(["verify", "--input", at("shards"), "--canvas", "4", "--min-blocks", "10"])
    assert said()["enough"]
    cli.main(["check", "--input", at("shards")])
    assert said()["exists"]
    cli.main(["presets", "--style", "bash"])
    assert "export DG_" in capsys.readouterr().out


def test_reports_and_logs(spark, tmp_path):
    writers.write_report(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "r"))
    writers.write_report(spark.createDataFrame([(2, None)], "a int, b string"), str(tmp_path / "r"))
    assert [r["a"] for r in spark.read.json(str(tmp_path / "r")).collect()] == [2]
