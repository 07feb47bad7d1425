"""Training and scoring with Spark ML; feature preparation stays in column expressions."""
