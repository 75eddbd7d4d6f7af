"""Queries of the training-data operators: name to (query, SQL or None)."""

from lakegate.llm import (
    ann,
    collocations,
    decontamination,
    exact_dedup,
    html_text,
    language,
    minhash,
    mixing,
    packing,
    pii,
    quality,
    sharding,
    whitening,
)

QUERIES = {
    **packing.QUERIES,
    **html_text.QUERIES,
    **pii.QUERIES,
    **mixing.QUERIES,
    **ann.QUERIES,
    **quality.QUERIES,
    **sharding.QUERIES,
    **exact_dedup.QUERIES,
    **minhash.QUERIES,
    **language.QUERIES,
    **decontamination.QUERIES,
    **collocations.QUERIES,
    **whitening.QUERIES,
}
