"""Operators for training-data pipelines; nothing else in the library imports this package.

    chat_format   conversations to training text, proved reversible      (native)
    partenum      exact n-gram Jaccard self-join by PartEnum signatures
    langid        interpolated Kneser-Ney character models
    fm_dedup      repeated word windows by sharded FM-indexes
    packing       vector best-fit packing of token pieces
    sp_codec      SentencePiece encoding with byte offsets, and decoding
    licenses      Dice coefficient against licence templates              (native)
    secrets       credential patterns and token-efficiency spans
    kmeans_tree   hierarchical k-means nearest neighbours
    quality       base rules and hashed n-gram likelihood ratios          (native)
    importance    importance resampling towards a target by hashed n-grams
    filter_audit  interaction of filters over every order, by a recursive query
    bpe_codec     byte-pair encoding by backtracking, decoding by an offset table
    queries       the registered queries, opN_<name>
"""
