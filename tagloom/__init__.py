"""Topic tagging of question-and-answer posts, written as Spark jobs."""
