"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; `queries.py` registers its queries.

    topk          exact top-k inner-product search over norm buckets
    warc          WARC archives with an index of byte ranges, read back by coalesced ranges
    urls          URL rules and empirical-Bayes host reputation
    simhash       SimHash near-duplicate groups by multi-index hashing
    decontam      benchmark passages found by one Aho-Corasick automaton
    pii           keyed format-preserving pseudonyms (SQL functions only)
    token_store   token ids in zstandard files with a trained dictionary
    bpe           byte-pair encoding and decoding
    toxicity      FTRL-proximal logistic regression
    substrings    repeated word passages by window hashes in prefix groups
    merkle        Merkle manifest with proofs, by cogrouped superblocks
    packing       training sequences of related documents, by BM25 retrieval
    spelling      words one edit apart and their frequent forms, by PartEnum signatures
    components    connected components, used by `simhash`
"""
