from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from lossmill.llm.encoding import Encoder, WordEncoder, encoder
from lossmill.llm.packing import pack
from tokenizers import Tokenizer

LETTERS = "abzÀÉéüßÿ×÷ªµ́̈łſİΣςЖ中한 \n\t\u0085  's.-<|>12²"


@pytest.mark.parametrize(
    "name, kind", [("word_bpe_49k.json", WordEncoder), ("byte_bpe_50k.json", Encoder)]
)
def test_ids_are_those_of_the_tokenizer(name, kind):
    path = public_tokenizers.path(name)
    tokenizer, own = Tokenizer.from_file(path), encoder(path)
    assert type(own) is kind

    @settings(max_examples=300, deadline=None)
    @given(st.one_of(st.text(max_size=40), st.text(alphabet=LETTERS, max_size=40)))
    def same(text):
        got = np.frombuffer(own.encode(text), "<u4").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids

    same()


def test_packing_with_a_tokenizer_that_keeps_white_space(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    text = "Hello  world\n\n tabs\there"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = pack(docs, path, with_ids=True).orderBy("start").limit(1).collect()
    ids = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert row.doc_tokens == len(ids) + 1
    assert np.frombuffer(row.ids, "<u4").tolist() == [*ids, 1][: row.length]
