"""The queries of this folder and their SQL twins, by name."""

from __future__ import annotations

from vigil.llm import bpe, decontam, exact, language, licences, manifest, near, pieces, preference, repeats, urls, warc, whitening

MODULES = (preference, repeats, decontam, licences, warc, near, language, urls, pieces, exact, manifest, whitening, bpe)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
