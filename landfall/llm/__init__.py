"""Training-data operators: tokens, language, packing, quality, duplicates, search, licences and toxicity.

Every operator takes and returns DataFrames, works on whole tables and whole texts, and states in its docstring what it
does with nulls, empty input, ties and repeated rows. Nothing else in the library imports this package.
"""
