"""Readers and writers of Bronze snapshots and run manifests."""
