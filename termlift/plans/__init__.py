"""End-to-end jobs and the helpers that keep them safe at scale."""
