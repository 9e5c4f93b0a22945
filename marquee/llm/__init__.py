"""Training-data operators over the ``documents`` tables.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; ``queries`` binds them to the registered
``opN_<name>`` queries. Shared helpers: ``common`` (session, scratch tables),
``textnp`` (vectorised words and hashes), ``blobs`` (array packing),
``exchange`` (blocks of documents asking hash shards), ``bpe`` (token ids).
"""
