"""End-to-end jobs (training, scoring), fixtures and registered queries."""
