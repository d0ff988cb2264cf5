"""ERP analytics warehouse built from Spark DataFrame operators."""
