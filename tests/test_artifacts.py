from pyspark.sql import functions as F

from quern.operators import artifacts as A


def test_artifacts(spark):
    files = spark.createDataFrame([("/m/config.json", "a"), ("/m/tokenizer.model", "b"), ("/m/model-00001-of-2.safetensors", "c")], "path string, text string")
    assert A.artifact_report(files).first().asDict() == {"exists": True, "has_config": True, "has_tokenizer": True, "has_weights": True}
    assert A.artifact_report(files.limit(0)).first().asDict() == {"exists": False, "has_config": False, "has_tokenizer": False, "has_weights": False}
    assert A.text_checks(files, {"x": ("config.json", ["a"]), "y": ("config.json", ["a", "z"])}).first().asDict() == {"x": True, "y": False}


def test_settings(spark):
    one = lambda m: dict(spark.createDataFrame([(m,)], "m map<string,string>").select(A.text_settings(F.col("m"))).first()[0])
    assert one({"intermediate_size": "8", "num_key_value_heads": "2", "odd": "1"}) == {
        "intermediate_size": "8", "num_key_value_heads": "2", "use_bidirectional_attention": "all", "final_logit_softcapping": "30.0", "num_experts": "1", "top_k_experts": "1",
        "moe_intermediate_size": "8", "num_global_key_value_heads": "2",
    }
    assert one({"num_experts": "4", "top_k_experts": "2", "num_global_key_value_heads": "1"})["top_k_experts"] == "2"
    ids = spark.createDataFrame([({"image_token_id": "5"},)], "m map<string,string>").select(A.token_ids(F.col("m"))).first()[0]
    assert ids["image_token_id"] == 5 and ids["audio_token_id"] == 258881
