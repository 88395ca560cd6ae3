"""Training-data operators over document tables (scoring, near-duplicates,
licences, language models, tokenisation, decontamination).

Every operator takes DataFrames plus parameters and returns a DataFrame; the
thin registered queries are in :mod:`kestrel.llm.queries`."""
