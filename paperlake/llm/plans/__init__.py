"""Queries of the text operators; MODULES lists the modules with QUERIES and ORACLES."""

from paperlake.llm.plans import canonical, encoding, language, leakage, markup, mixing, quality, quantiles, sentences

MODULES = [encoding, canonical, quantiles, language, quality, markup, leakage, mixing, sentences]
