"""tallyward: card-transaction fraud analytics as Spark DataFrame operators."""
