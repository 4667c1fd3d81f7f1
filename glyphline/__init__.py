"""Symbol (emoji) and sentiment analytics as Spark DataFrame operators."""
