"""Training-data operators: mixing, packing, near and exact dedup, output formats, quality, toxicity, language.

Every module offers an operator on DataFrames of documents; :mod:`natspark.llm.queries` applies each of them to the
whole ``documents`` table. Nothing outside this subpackage imports it.
"""
