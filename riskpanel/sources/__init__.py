"""Readers and writers: messy CSV folders, month-partitioned history, artefacts."""
