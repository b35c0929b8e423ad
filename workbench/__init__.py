"""The given test tables in the shapes the library reads, the registered queries, and their SQL."""
