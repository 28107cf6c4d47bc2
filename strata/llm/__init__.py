"""Training-data operators: quality, deduplication, language, tokens, packing, chat, output files.

Nothing outside this subpackage imports it.  The operators live one per module;
:mod:`strata.llm.queries` registers one query for each.
"""
