"""lectern: catalogue search on Spark (text analysis, inverted index, hybrid and fuzzy search, catalogue
changes, reply extraction) written as DataFrame / Spark SQL jobs. See README.md."""
