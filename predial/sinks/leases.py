"""Leases on working folders, so that those of killed runs are found and removed.

A run that opens a working folder leaves a lease in it and renews it as long as it lives. A
later run removes the neighbours whose lease wasn't renewed for `EXPIRY` seconds. Folders
without a lease are somebody else's and stay.
"""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession

from predial.sinks.folders import Folders

EXPIRY = 1800.0
RENEWALS = 20  # in the time of an expiry
NAME = "_lease"  # hidden from Spark's readers


class Lease:
    """A folder in use, until `release`."""

    def __init__(self, spark: SparkSession, folder: str, expiry: float | None = None):
        self.folder, self.expiry = folder, EXPIRY if expiry is None else expiry
        self._folders = Folders(spark, folder)
        self._owner = spark.sparkContext.applicationId
        self._over = threading.Event()
        self._renew()
        threading.Thread(target=self._keep_renewing, daemon=True).start()

    @property
    def path(self) -> str:
        return f"{self.folder}/{NAME}"

    def _renew(self) -> None:
        self._folders.write(self.path, {"application": self._owner})

    def _keep_renewing(self) -> None:
        while not self._over.wait(max(self.expiry / RENEWALS, 0.05)):
            try:
                self._renew()
            except Exception:  # the session or the folder is gone, and the lease with it
                return

    def release(self) -> None:
        self._over.set()

    def sweep(self, parent: str) -> list[str]:
        """Remove the expired neighbours under `parent`; their names.

        Ages are told against this lease, renewed just now, so clocks of machines don't matter.
        """
        self._renew()
        gone = []
        for name in self._folders.names(parent):
            other = f"{parent}/{name}/{NAME}"
            if f"{parent}/{name}" == self.folder or not self._folders.exists(other):
                continue
            try:
                expired = self._folders.age(other, self.path) > self.expiry
            except Exception:  # its run has just removed it
                continue
            if expired:
                self._folders.remove(f"{parent}/{name}")
                gone.append(name)
        return gone
