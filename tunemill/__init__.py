"""Instruction-tuning data preparation and run tracking as Spark DataFrame jobs."""
