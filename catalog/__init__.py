"""Every operator bound to the driver tables, each with an independent DuckDB query."""

from catalog import corpus, detect, labelled, streams, text, variants

MODULES = [text, detect, corpus, labelled, variants, streams]
