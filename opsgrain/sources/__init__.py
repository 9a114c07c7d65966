"""Readers, writers and the processed-prompt ledger."""
