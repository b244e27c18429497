"""What a Python worker keeps between stages."""

import public_tokenizers

from ledgerleaf.llm import bpe, common


def test_a_worker_keeps_the_model_of_one_stage():
    common.kept("an earlier stage", lambda: [0] * 10)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    first = bpe.encoder(path, public_tokenizers.PATTERN)
    assert bpe.encoder(path, public_tokenizers.PATTERN) is first
    assert list(common._kept.values()) == [first]
