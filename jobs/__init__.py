"""Runnable jobs over the given tables: each a function of a session, with a command line and a config file of its own."""
