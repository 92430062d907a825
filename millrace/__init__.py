"""Millrace: daily batch feeds to trusted tables and marts, as Spark plans."""
