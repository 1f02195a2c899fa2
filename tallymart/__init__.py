"""tallymart: retail lakehouse analytics as plain PySpark DataFrame operators."""
