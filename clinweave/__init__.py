"""Clinical change data to FHIR resources, as Spark DataFrame jobs."""

from clinweave.session import session
from clinweave.settings import Settings

__all__ = ["Settings", "session"]
