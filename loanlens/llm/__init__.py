"""Training-data operators: quality, near duplicates, search, URL rules, language,
mixing, sharding, packing, chat rendering and line de-duplication.

Nothing else in the library imports this package.
"""
