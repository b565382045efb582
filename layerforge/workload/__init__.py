"""The registered queries: the library's plans over the benchmark tables, with SQL oracles."""
