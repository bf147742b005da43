"""Readers: text lines, meter files, vendor layouts, maps, tables and manifests."""
