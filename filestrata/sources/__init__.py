"""Scans: folders of files, delimited text, workbooks, control tables."""
