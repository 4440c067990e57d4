"""Declared schemas of the nine register files, and how each family is found and read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
}


def schema_of(columns: str) -> StructType:
    """Schema from "name type, name type, ...".

    StructType.fromDDL would need a running session at import time.
    """
    pairs = (column.split() for column in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


# Fixed column names and types of the nine files, in file order.
SIMPLES = schema_of(
    "cnpj_basico string, idc_op_simples string, dt_op_simples int, dt_exclusao_simples int,"
    " idc_op_mei string, dt_op_mei int, dt_exclusao_mei int"
)
CNAE = schema_of("cod_cnae int, nom_cnae string")
MUNICIPIO = schema_of("cod_municipio int, nom_municipio string")
NATUREZA_JURIDICA = schema_of("cod_nat_juridica int, nom_nat_juridica string")
PAIS = schema_of("cod_pais int, nom_pais string")
QUALIFICACAO_SOCIO = schema_of("cod_qualif_socio int, nom_qualif_socio string")
SOCIO = schema_of(
    "cnpj_basico string, cod_ident_socio int, nom_socio string, cnpj_cpf_socio string,"
    " cod_qualif_socio int, dt_entrada_sociedade int, cod_pais int, cpf_representante int,"
    " nom_representante string, cod_qualif_representante int, cod_faixa_etaria int,"
    " razao_social string"
)
EMPRESA = schema_of(
    "cnpj_basico string, razao_social string, cod_nat_juridica int, cod_qualif_socio int,"
    " capital_social string, cod_porte int, ente_federativo int"
)
ESTABELECIMENTO = schema_of(
    "cnpj_basico string, cnpj_origem string, cnpj_dv string, cod_matriz_filial int,"
    " nom_fantasia string, cod_situacao_cadastral int, dt_situacao_cadastral int,"
    " cod_motivo_situcao_cadastral int, nom_cidade_exterior string, cod_pais int,"
    " dt_inicio_atividade int, cod_cnae_principal int, cod_cnae_secundario int,"
    " tipo_logradouro string, logradouro string, numero int, complemento string,"
    " bairro string, cep string, uf string, cod_municipio int, ddd_1 int, telefone_1 int,"
    " ddd_2 int, telefone_2 int, ddd_fax int, fax int, email string, sit_especial string,"
    " dt_sit_especial int"
)


def widen(schema: StructType, *columns: str) -> StructType:
    """The schema with some columns as text."""
    return StructType(
        [StructField(f.name, StringType()) if f.name in columns else f for f in schema.fields]
    )


@dataclass(frozen=True)
class Family:
    """One kind of register file: name pattern, declared schema and quote escape.

    ``text`` lists columns declared as integers that mostly hold something else, such as
    masked ids, code lists or "S/N".
    """

    glob: str
    schema: StructType
    escape: str | None = None
    text: tuple[str, ...] = ()

    @property
    def wide(self) -> StructType:
        """The schema with those columns as text, so that no value is lost."""
        return widen(self.schema, *self.text)


# Fixed file-name patterns. Only the establishment files double their quotes.
FAMILIES = {
    "simples": Family("*SIMPLES.CSV*", SIMPLES),
    "cnae": Family("*.CNAECSV", CNAE),
    "municipio": Family("*.MUNICCSV", MUNICIPIO),
    "natureza_juridica": Family("*.NATJUCSV", NATUREZA_JURIDICA),
    "pais": Family("*.PAISCSV", PAIS),
    "qualificacao_socio": Family("*.QUALSCSV", QUALIFICACAO_SOCIO),
    "socio": Family("*.SOCIOCSV", SOCIO, text=("cpf_representante",)),
    "empresa": Family("*.EMPRECSV", EMPRESA, text=("ente_federativo",)),
    "estabelecimento": Family(
        "*.ESTABELE", ESTABELECIMENTO, '"', text=("cod_cnae_secundario", "numero")
    ),
}
