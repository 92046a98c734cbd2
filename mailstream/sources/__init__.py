"""Sources: tables, file-backed and Kafka topics, line files, the poll clock
and the page fetcher."""
