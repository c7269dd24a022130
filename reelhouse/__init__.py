"""reelhouse: review-warehouse operators written as Spark DataFrame jobs."""
