"""cardwatch: card-transaction risk analytics as PySpark DataFrame operators."""
