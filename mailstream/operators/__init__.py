"""DataFrame -> DataFrame operators (batch and foreachBatch alike)."""
