"""Turn large archives of landed web pages about broadcast news into flat tables."""

__version__ = "0.1.0"
