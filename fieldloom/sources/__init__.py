"""Readers and writers: tables with checked schemas, staged CSV, versions and checkpoints."""
