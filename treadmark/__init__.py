"""treadmark: product scoring, slot selection and merchandising reports as Spark jobs."""
