"""Filings and mapping revisions as streams."""
