"""Java functions for columns, compiled with Spark's own compiler from a source beside this module.

The driver compiles them once, with the compiler that Spark uses for its plans, so neither it nor an executor needs a JDK, and
gives Spark a jar of them, which every executor fetches.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable
from functools import lru_cache, partial
from pathlib import Path

from py4j.java_gateway import JVMView
from pyspark.sql import Column, SparkSession, functions as F

PACKAGE = "chronofold"



@lru_cache(maxsize=8)
def _jar(jvm: JVMView, source: str) -> str:
    """A jar of the classes of a source, which lasts as long as this process."""
    compiler = jvm.org.codehaus.janino.SimpleCompiler()
    compiler.cook(Path(__file__).with_name(source).read_text(encoding="utf-8"))
    folder = tempfile.mkdtemp(prefix=f"{PACKAGE}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/{Path(source).stem}.jar"
    with zipfile.ZipFile(path, "w") as jar:
        for name, code in dict(compiler.getBytecodes()).items():
            jar.writestr(f"{name.replace('.', '/')}.class", bytes(code))
    return path


def functions(spark: SparkSession, source: str, **types: str) -> list[Callable[[Column | str], Column]]:
    """The functions of classes in a source, for columns: by name, the type of each one's result."""
    names = [f"{PACKAGE}_{name}" for name in types]
    if not all(map(spark.catalog.functionExists, names)):
        jvm = spark._jvm
        # also shows the jar to this thread
        spark.sql(f"ADD JAR '{_jar(jvm, source)}'")
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        for name, type_ in types.items():
            made = loader.loadClass(f"{PACKAGE}.{name}").getDeclaredConstructor(None).newInstance(None)
            result = jvm.org.apache.spark.sql.types.DataType.fromDDL(type_)
            spark._jsparkSession.udf().register(f"{PACKAGE}_{name}", made, result)
    return [partial(F.call_function, name) for name in names]
