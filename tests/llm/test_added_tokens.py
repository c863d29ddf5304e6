"""Ids are those of the vocabulary's tokenizer as loaded, added tokens included."""
import struct
import zlib

import corpus_pipeline

from perfwatch.llm import packing, queries

TEXTS = ["stop <|endoftext|> now", "<|endoftext|>", "a<|endoftext|>b", "<|endoftext|><|endoftext|> x", "<|endoftext|> a b\n",
         "two  spaces <|endoftext|>\n\n", "<|endoftext| >", "no such token here"]


def reference():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    return {text: tokenizer.encode(text, add_special_tokens=False).ids for text in TEXTS}


def test_token_ids_of_added_tokens():
    ids_of = packing.TokenIds(packing.vocabulary_path(), 50, added_tokens=True)
    want = reference()
    assert want[TEXTS[0]] == [11338, 220, 50256, 783]
    for text in TEXTS * 2:
        assert ids_of(text) == struct.pack(f"<{len(want[text])}I", *want[text]), text


def test_query_and_stage_give_added_tokens(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(TEXTS)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = {}
    for i, ids in enumerate(reference().values()):
        body = struct.pack(f"<{len(ids) + 1}I", *ids, packing.END_ID)
        want[i] = (0, len(ids) + 1, len(ids) + 1, zlib.crc32(body))
    for pieces in (queries.op1_packing(spark, str(tmp_path)), corpus_pipeline.pack(spark, docs, str(tmp_path))):
        assert {r["doc_id"]: (r["start"], r["length"], r["doc_tokens"], r["ids_crc32"]) for r in pieces.collect()} == want
