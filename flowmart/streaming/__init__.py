"""Structured Streaming forms: keyed-state processors (T5-T9), stream readers
and writers, and runnable jobs with checkpoints (T13)."""
