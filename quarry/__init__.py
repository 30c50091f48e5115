"""quarry: hybrid retrieval and ranking evaluation as Spark DataFrame jobs.

Layout
------
``functions``  column expressions (tokenizer, snippet, vector math, hashing)
``sources``    readers / writers and the fixture mapping of the driver tables
``operators``  DataFrame-in / DataFrame-out operators (corpus, bm25, dense,
               encode, fusion, retrieve, relevance, metrics, report)
``streaming``  incremental (Structured Streaming) encoding
``plans``      broadcast sizing, the named query catalog and its SQL oracle
"""

__version__ = "0.1.0"
