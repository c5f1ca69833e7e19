import os

from conftest import AS_OF
from tidestrata.plans import land_raw
from tidestrata.sources import api_statistics, category_documents


def landed(spark, folder, compression):
    one = '{"items": [{"id": "%s", "snippet": {"title": "t"}, "statistics": {"viewCount": "5"}}]}'
    rows = [("us", "trending", one % "a"), ("us", "trending", one % "b"), ("ca", "trending", one % "c")]
    rows += [("us", "categories", '{"items": [{"id": "1", "snippet": {"title": "Music"}}]}')]
    payloads = spark.createDataFrame(rows, "region string, kind string, payload string")
    manifest = land_raw(payloads, str(folder), "source", AS_OF, compression)
    videos = api_statistics(spark, f"{folder}/raw_statistics", layout="lines")
    categories = category_documents(spark, f"{folder}/raw_statistics_reference_data", layout="lines")
    fields = [c for c in categories.columns if not c.startswith("_")]
    return (
        sorted(manifest.collect()),
        sorted(videos.select("region", "id").collect()),
        sorted(categories.select(*fields).collect()),
    )


def test_landed_text_can_be_compressed_and_read_back(spark, tmp_path):
    plain = landed(spark, tmp_path / "plain", None)
    packed = landed(spark, tmp_path / "packed", "gzip")
    files = [p for p in (tmp_path / "packed").rglob("part-*")]
    assert files and all(p.name.endswith(".txt.gz") for p in files)
    assert packed == plain
    assert len(plain[1]) == 3 and len(plain[2]) == 1


def test_staged_payloads_are_zstd_parquet(spark, tmp_path, monkeypatch):
    import tidestrata.plans.landing as landing

    seen = []
    monkeypatch.setattr(landing, "discard", lambda spark, folder: seen.append(folder))
    one = '{"items": [{"id": "%s"}]}'
    rows = [("us", "trending", one % "a"), ("ca", "trending", "{broken"), ("us", "categories", one % "1")]
    payloads = spark.createDataFrame(rows, "region string, kind string, payload string")
    manifest = landing.land_raw(payloads, str(tmp_path / "out"), "source", AS_OF, "gzip")
    assert len(seen) == 1
    files = [p for p in os.listdir(seen[0]) if p.startswith("part-")]
    assert files and all(p.endswith(".zstd.parquet") for p in files)
    statuses = sorted((r["region"], r["kind"], r["status"]) for r in manifest.collect())
    assert statuses == [("ca", "trending", "failed"), ("us", "categories", "success"), ("us", "trending", "success")]
