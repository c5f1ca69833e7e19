"""Queries over small tables of their own."""

import zlib

from tokenizers import Tokenizer

from tidestrata.llm import packing, queries


def written(spark, folder, rows):
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_special_strings_have_the_ids_of_the_vocabulary(spark, tmp_path):
    import public_tokenizers

    texts = ["a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> <|endoftext|>\n<|endoftext", "x <|im_start|>"]
    texts += ["a" + " " * 300_000 + "b<|endoftext|> c", None]
    tokens = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    expected = set()
    for i, text in enumerate(texts):
        ids = tokens.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, (start, length) in enumerate(packing.cut_places(len(ids))):
            data = b"".join(x.to_bytes(4, "little") for x in ids[start : start + length])
            expected.add((i, piece, length, zlib.crc32(data)))
    assert tokens.encode(texts[0], add_special_tokens=False).ids == [64, 50256, 65]
    placed = queries.op7_packing(spark, written(spark, tmp_path, list(enumerate(texts)))).collect()
    assert {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in placed} == expected
