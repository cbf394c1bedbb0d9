import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tapewright.llm import packing


def test_packed_ids_are_those_of_the_unmodified_tokenizer(spark):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a<|endoftext|>b", "<|endoftext|><|endoftext|>", "no such string", "<|endoftext |>", " x <|endoftext|> y"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4")[:-1].tolist() for r in packing.pack(frame).collect()}
    assert got == {i: whole.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert 50256 in got[0]
