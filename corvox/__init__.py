"""Corvox: a Spark-first engine for speech and text corpora.

The subpackages hold DataFrame operators (`operators`), readers and writers
(`sources`), column functions (`functions`), registered queries (`plans`) and
streaming forms of the same operators (`streaming`).
"""
