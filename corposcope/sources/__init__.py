"""Readers and writers: metadata pages, transcripts, status logs, manifests, events."""
