"""Customer-behaviour analytics for retail banking, expressed as Spark DataFrame plans."""
