import json

import pytest
from pyspark.sql import functions as F

from quern.operators import blocks, clients, scores, weights
from quern.plans import shards as shard_plan
from quern.plans import teacher
from quern.sources import readers, writers
from quern.streaming import streams


def prompt_rows(spark, n):
    return spark.createDataFrame([(f"r{i:03d}", "s", "text", f"question {i}", None, None, {"dataset": "s"}) for i in range(n)],
                                 "id string, source string, modality string, prompt_text string, context_text string, media map<string,array<string>>, metadata map<string,string>")


def test_generation_resumes_and_stops_at_the_budget(spark, tmp_path):
    out, config = str(tmp_path / "out"), clients.TeacherConfig(runtime="offline", model="m")
    df = prompt_rows(spark, 30)
    per = teacher.generate_records(df, config).first()["estimated_tokens"]
    assert teacher.run(df, config, out, ["id"], target_tokens=per * 4, chunk=10) == 4
    assert teacher.run(df, config, out, ["id"], target_tokens=per * 4, chunk=10) == 0
    assert teacher.run(df, config, out, ["id"], chunk=20) == 26
    got = spark.read.json(out)
    assert got.count() == 30 == got.select("id").distinct().count()


def test_generation_passes_prompts_that_cannot_be_asked(spark, tmp_path):
    out, config = str(tmp_path / "out"), clients.TeacherConfig(runtime="offline", model="m")
    df = prompt_rows(spark, 30)
    first = F.col("id") < "r012"
    df = df.withColumn("prompt_text", F.when(first, F.lit(" ")).otherwise(F.col("prompt_text"))).withColumn("media", F.when(F.col("id") < "r003", F.create_map(F.lit("images"), F.array(F.lit("a.png")))))
    df = df.unionByName(df.where("id = 'r020'").withColumn("id", F.lit(None).cast("string")))
    assert teacher.run(df, config, out, ["id"], chunk=5) == 18
    assert {r["id"] for r in spark.read.json(out).collect()} == {f"r{i:03d}" for i in range(12, 30)}


def test_generation_ends_when_only_quarantined_prompts_are_left(spark, tmp_path):
    out, bad, config = str(tmp_path / "out"), str(tmp_path / "bad"), clients.TeacherConfig(runtime="offline", model="m")
    asked = []

    class Silent(clients.Offline):
        def generate(self, prompt, content=None):
            return "" if prompt[-1] in "05" else super().generate(prompt, content)

    def append(*a):
        asked.append(1)
        assert len(asked) <= 10, "the same prompts are asked again and again"
        writers.append_records(*a)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(teacher, "append_records", append)
        teacher.run(prompt_rows(spark, 20), config, out, ["id"], chunk=3, quarantine=bad, make=Silent)
    assert spark.read.json(out).count() == 16
    assert sorted(r["id"] for r in spark.read.json(bad).collect()) == ["r000", "r005", "r010", "r015"]


def test_clients():
    calls = []

    def post(url, body, config):
        calls.append(url)
        if url.endswith("/completions") and "/chat" not in url:
            raise clients.urllib.error.HTTPError(url, 404, "no", None, None)
        return {"choices": [{"message": {"content": "chat"}, "text": "plain"}], "response": "raw"}

    c = clients.Completions(clients.TeacherConfig(), post)
    assert c.generate("p") == "chat" and len(calls) == 2
    assert c.generate("p", [{"type": "text", "text": "p"}]) == "chat" and len(calls) == 3
    o = clients.Ollama(clients.TeacherConfig(runtime="ollama"), post)
    assert o.generate("p") == "raw"
    with pytest.raises(RuntimeError):
        o.generate("p", [{"type": "text"}])
    with pytest.raises(ValueError):
        clients.make_client(clients.TeacherConfig(runtime="other"))


def test_build_shards(spark, tmp_path):
    rows = [(f"r{i}", f"prompt {i}", "", " ".join(f"w{i}x{k}" for k in range(i % 13))) for i in range(40)]
    df = spark.createDataFrame(rows, "id string, prompt_text string, context_text string, text string")
    s = shard_plan.build_shards(df, target_blocks_n=45, canvas=4, prefix=8, shard_blocks=10, vocabulary=1000)
    got = s.collect()
    assert len(got) == 45 and {r["shard_id"] for r in got} == {0, 1, 2, 3, 4}
    assert all(len(r["target_ids"]) == len(r["corrupted_ids"]) == 4 and len(r["prefix_ids"]) == 8 for r in got)
    again = shard_plan.build_shards(df.repartition(6), target_blocks_n=45, canvas=4, prefix=8, shard_blocks=10, vocabulary=1000).collect()
    key = lambda r: (r["id"], r["block"], r["shard_id"], tuple(r["corrupted_ids"]))
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert blocks.verify_shards(s, 4, 45).first().asDict() == {"shards": 5, "blocks": 45, "target_length_ok": True, "same_length_ok": True, "enough": True}
    writers.write_shards(s, str(tmp_path / "shards"))
    back = readers.read_shards(spark, str(tmp_path / "shards"))
    assert back.count() == 45 and back.where(F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x) != F.col("prefix_lens")).count() == 0
    assert blocks.verify_shards(s.limit(0), 4).first()["shards"] == 0


def test_shards_follow_the_buffers(spark):
    """Against the sequential rule: a signature's buffer is flushed when full, tails in first-seen order, ids per family."""
    import random

    rnd = random.Random(3)
    seq = [rnd.choice("abc") for _ in range(57)]
    fam = {"a": "text", "b": "image", "c": "text"}
    buffers, ids, want = {}, {"text": 0, "image": 0}, {}
    def flush(s):
        for i in buffers[s]:
            want[i] = ids[fam[s]]
        ids[fam[s]] += 1
        buffers[s] = []
    for i, s in enumerate(seq):
        buffers.setdefault(s, []).append(i)
        if len(buffers[s]) == 5:
            flush(s)
    for s in list(buffers):
        if buffers[s]:
            flush(s)
    df = spark.createDataFrame([(i, s, fam[s]) for i, s in enumerate(seq)], "i int, signature string, family string").repartition(4)
    assert {r["i"]: r["shard_id"] for r in blocks.shards(df, ["i"], 5).collect()} == want


def test_jsonl_readers(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text("\n".join(['{"id": "a"}', "  ", '{"id": "ü"}', "", '{"id": "c"}']) + "\n", encoding="utf-8")
    assert [r[0] for r in readers.read_jsonl(spark, str(p), "id string").collect()] == ["a", "ü", "c"]
    assert readers.read_jsonl_open(spark, str(p)).count() == 3
    spark.dataSource.register(readers.JsonLineOffsets)
    data = p.read_bytes()
    for chunk in (3, 7, 1000):
        rows = spark.read.format("jsonl_offsets").option("chunk", str(chunk)).load(str(p)).orderBy("offset").collect()
        assert [json.loads(r["line"])["id"] for r in rows] == ["a", "ü", "c"]
        assert all(data[r["offset"] :].decode().lstrip().startswith(r["line"]) for r in rows)
    assert [json.loads(r["line"])["id"] for r in readers.read_ordered(spark, str(p), "source").orderBy("position").collect()] == ["a", "ü", "c"]
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"id": 1\n')
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(bad), "id string").collect()


def test_manifests_and_config(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "one_x.jsonl").write_text('{"prompt": "p"}\n')
    rows, failed = readers.read_manifests(spark, [{"id": "1", "name": "one x"}, {"id": "2", "name": "gone"}], "prompt string", str(tmp_path / "m"))
    assert rows.first()["source_id"] == "1" and [f["source"] for f in failed] == ["2"]
    with pytest.raises(RuntimeError):
        readers.read_manifests(spark, [{"id": "2"}], "prompt string", str(tmp_path / "m"))
    (tmp_path / "c.json").write_text(json.dumps({"sources": [{"id": "a", "max_records": 3}, {"id": "b", "enabled": False}]}, indent=1))
    assert [(r["source_order"], r["id"], r["max_records"]) for r in readers.read_sources(spark, str(tmp_path / "c.json")).collect()] == [(0, "a", 3), (1, "b", None)]


def test_bundle_and_presets(spark, tmp_path):
    root = tmp_path / "r"
    (root / "__pycache__").mkdir(parents=True)
    (root / "a.txt").write_text("abc")
    (root / "__pycache__" / "x.pyc").write_text("no")
    files = readers.read_files(spark, str(root))
    s = writers.write_bundle(files, str(tmp_path / "b.tar.gz"), str(root))
    assert (s["files"], s["bytes"]) == (1, 3)
    assert files.first()["sha256"] == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    assert readers.read_files(spark, str(tmp_path / "missing")).count() == 0
    assert writers.presets("x", "bash", {"x": {"steps": 5}}) == 'export DG_STEPS="5"\nexport DG_TRAIN_MODE="$DG_TRAIN_MODE_LINUX"'
    assert json.loads(writers.presets())["target_blocks"] == 200_000


def test_audio_is_averaged_over_channels(spark, tmp_path):
    import wave

    with wave.open(str(tmp_path / "a.wav"), "wb") as w:
        w.setnchannels(2), w.setsampwidth(2), w.setframerate(8000)
        w.writeframes(b"\x00\x40\x00\x00" * 3)
    (tmp_path / "bad.wav").write_text("no audio")
    r = spark.createDataFrame([("x", {"audio": ["a.wav", "bad.wav", "gone.wav"]})], "id string, media map<string,array<string>>")
    got = readers.decode_audio(readers.read_media(spark, r, ("audio",), str(tmp_path))).orderBy("index").collect()
    assert [g["sampling_rate"] for g in got] == [8000, None] and [round(x, 3) for x in got[0]["samples"]] == [0.25] * 3


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "source string, x int")
    assert writers.write_jsonl(df, str(tmp_path / "o"))["by_source"] == {"a": 2, "b": 1}
    assert writers.write_jsonl(df.limit(0), str(tmp_path / "o"))["records"] == 0
    recs = spark.createDataFrame([("1", "p", None, "t", "s", None), ("2", "p", None, "", "s", None)], "id string, prompt_text string, context_text string, text string, prompt_source string, media map<string,array<string>>")
    with pytest.raises(Exception):
        writers.append_records(recs, str(tmp_path / "t"))
    writers.append_records(recs, str(tmp_path / "t"), str(tmp_path / "q"))
    assert spark.read.json(str(tmp_path / "t")).count() == 1 and spark.read.json(str(tmp_path / "q")).first()["violation"] == "no_text"


def test_weights(spark):
    schema = "key string, shape array<int>"
    base = spark.createDataFrame([("model.language_model.l.a", [2, 2]), ("model.language_model.l.mlp.gate_proj.weight", [3, 2]), ("model.language_model.l.mlp.up_proj.weight", [3, 2]), ("model.language_model.l.mlp.down_proj.weight", [2, 3]), ("lm_head.weight", [9, 2]), ("odd", [1]), (None, None)], schema)
    target = spark.createDataFrame([("model.encoder.language_model.l.a", [2, 2]), ("model.decoder.l.a", [3, 3]), ("model.decoder.l.experts.gate_up_proj", [1, 6, 2]), ("model.decoder.l.experts.down_proj", [1, 2, 3]), ("lm_head.weight", [9, 2]), ("model.decoder.l.router.per_expert_scale", [1]), ("other.key", [1]), ("model.decoder.l.new", [1])], schema)
    m = {r["key"]: r["status"] for r in weights.match(base, target).collect()}
    assert m == {"model.encoder.language_model.l.a": "copied", "model.decoder.l.a": "shape_mismatch", "model.decoder.l.experts.gate_up_proj": "composed", "model.decoder.l.experts.down_proj": "composed", "lm_head.weight": "copied", "model.decoder.l.router.per_expert_scale": "initialised", "model.decoder.l.new": "missing_source"}
    c = weights.coverage(weights.match(base, target))
    assert {r["family"]: r["ratio"] for r in c.collect()} == {"text_encoder": 1.0, "diffusion_decoder": 0.6, "lm_head": 1.0}
    assert weights.problems(c).first()["problems"] == ["missing_source_count=1", "shape_mismatch_count=1"]
    towers = spark.createDataFrame([("model.encoder.vision_tower.a", [1]), ("model.encoder.embed_vision.a", [1])], schema)
    partial = weights.coverage(weights.match(towers.limit(1).selectExpr("replace(key, 'encoder.', '') key", "shape"), towers))
    assert weights.problems(partial, weights.load_differences(towers, towers)).first()["problems"] == ["missing_source_count=1", "image_text_partial_copy"]
    whole = weights.coverage(weights.match(towers.selectExpr("replace(key, 'encoder.', '') key", "shape"), towers))
    assert weights.problems(whole).first()["problems"] == [] and weights.flags(whole).first().asDict() == {"image_text_target_present": True, "image_text_fully_copied": True, "audio_text_target_present": False, "audio_text_fully_copied": False}
    assert weights.coverage(weights.match(base, target.limit(0))).count() == 0


def test_entropy_accept_falls_back_per_batch(spark):
    rows = [("x", 0, 0, 0.5, 1), ("x", 0, 1, 0.01, 2), ("x", 1, 0, 0.9, 3), ("y", 0, 0, 0.7, 4), ("y", 0, 1, 0.7, 5), ("y", 1, 0, None, 6)]
    df = spark.createDataFrame(rows, "b string, r int, p int, entropy double, top int")
    got = {(r["b"], r["r"], r["p"]): r["accepted"] for r in scores.entropy_accept(df, 0.1, "b", "r", "p", 100, 1).collect()}
    assert got == {("x", 0, 0): False, ("x", 0, 1): True, ("x", 1, 0): False, ("y", 0, 0): True, ("y", 0, 1): False, ("y", 1, 0): True}


def test_step_logs(spark):
    df = spark.createDataFrame([("a", i, s, v) for i, (s, v) in enumerate([("p", 3.0), ("p", float("nan")), ("q", 2.0), ("q", None), ("q", 5.0), ("p", 1.0)])], "g string, step int, s string, v double")
    st = scores.stability(df, ["g"], "step", F.col("s"))
    assert [r["stable"] for r in st.orderBy("step").collect()] == [0, 1, 0, 1, 2, 0]
    assert scores.early_stop(st, ["g"], "step", "v", 0.1, stable_steps=2).first()["stop_step"] == 4
    assert [r["best"] for r in scores.running_best(df, ["g"], "step", "v").orderBy("step").collect()] == [3.0, 3.0, 2.0, 2.0, 2.0, 1.0]
    c = scores.counters(df, ["g"], "step", 2, seen=F.lit(1)).orderBy("step").collect()
    assert [r["boundary"] for r in c] == [False, True] * 3 and c[-1]["optimizer_steps"] == 3 and c[-1]["seen"] == 6


def test_stream_appends_each_record_once(spark, tmp_path):
    src, out, q, ck = (str(tmp_path / n) for n in ("in", "out", "q", "ck"))
    schema = "id string, prompt_text string, context_text string, text string, prompt_source string, media map<string,array<string>>"
    write = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(src)
    write([("1", "p", None, "t", "s", None), ("1", "p", None, "t", "s", None), ("2", "p", None, None, "s", None)])
    streams.append_records(streams.file_stream(spark, src, schema), out, q, ck).awaitTermination()
    write([("1", "p", None, "t", "s", None), ("3", "p", None, "t", "s", None)])
    streams.append_records(streams.file_stream(spark, src, schema), out, q, ck).awaitTermination()
    assert sorted(str(r["id"]) for r in spark.read.json(out + "/*").collect()) == ["1", "3"]
    assert [r["id"] for r in spark.read.json(q + "/*").collect()] == ["2"]
