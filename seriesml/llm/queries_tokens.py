"""Queries of the token files and of packing."""

from __future__ import annotations

import public_tokenizers

from seriesml.llm.packing import Limits, packed_documents
from seriesml.llm.registry import query, table
from seriesml.llm.token_files import checksums, read_tokens, write_tokens
from seriesml.session import scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@query("op2_token_files")
def op2_token_files(spark, sf):
    """All documents encoded, written as ORC and read back."""
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf, "documents"), path, TOKENIZER, end_id=2)
    return checksums(read_tokens(spark, path))


@query("op7_best_fit_packing")
def op7_best_fit_packing(spark, sf):
    """All documents packed into sequences of at most 2048 tokens."""
    return packed_documents(table(spark, sf, "documents"), TOKENIZER, end_id=0, limits=Limits(tokens=2048))
