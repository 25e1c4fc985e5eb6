"""Operators for training-data pipelines: text quality, privacy, de-duplication,
decontamination, mixing, sharding and token output.  Nothing outside this
subpackage imports it."""
