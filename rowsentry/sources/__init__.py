"""Readers and writers: labelled tables, requests, responses, reports, captures, fitted objects."""
