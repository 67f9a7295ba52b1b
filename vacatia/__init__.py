"""Job-posting and corpus analytics as DataFrame plans."""
