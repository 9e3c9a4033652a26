"""siltstone: a layered (bronze / silver / gold) batch analytics library on Spark."""
