"""Readers and writers: sitemap XML, state snapshots, the batch sink."""
